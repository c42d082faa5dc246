import json

from pyspark.sql import functions as F

from routeloom.operators import panels, paths
from routeloom.sources import writers

ITEMS = "draw long, seq long, op string, pts array<struct<x:double,y:double>>"


def test_paths(spark):
    rows = [
        (1, 0, "l", [(0.0, 0.0), (3.0, 4.0)]), (1, 1, "l", [(3.0, 4.005), (3.0, 0.0)]), (1, 2, "h", []), (1, 3, "h", []), (1, 4, "re", [(0.0, 0.0), (2.0, 1.0)]),
        (1, 5, "l", [(9.0, 9.0), (9.0, 8.0)]), (1, 6, "l", [(7.0, 7.0), (6.0, 7.0)]), (2, 0, "h", []), (3, 0, "c", [(0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.0, 0.0)]), (3, 1, "qu", [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]),
    ]
    d = spark.createDataFrame(rows, ITEMS)
    m = {r.draw: r for r in paths.path_metrics(d, ["draw"]).collect()}
    assert round(m[1].length, 3) == 17.005 and (m[1].segments, m[1].closed, m[2].length, m[2].closed, m[3].curves) == (8, 3, 0.0, 1, 1)
    apart = paths.separate_lines(d, ["draw"]).orderBy("draw", "seq").collect()
    assert [(r.draw, r.seq, len(r.points)) for r in apart] == [(1, 0, 2), (1, 1, 2), (1, 2, 2), (1, 4, 5), (1, 5, 2), (1, 6, 2), (3, 0, 17), (3, 1, 5)]
    whole = paths.joined_lines(d, ["draw"]).orderBy("draw", "line_no").collect()
    assert [(r.draw, len(r.points)) for r in whole] == [(1, 4), (1, 5), (1, 2), (1, 2), (3, 17), (3, 5)]
    assert [tuple(p) for p in whole[0].points] == [(0.0, 0.0), (3.0, 4.0), (3.0, 0.0), (0.0, 0.0)]
    assert paths.joined_lines(d.limit(0), ["draw"]).count() == 0


def test_cells(spark):
    lines = [(1, [(0.0, 0.0), (40.0, 33.0)]), (2, [(5.0, 5.0)]), (3, []), (4, [(0.5, 2.0), (0.5, 2.0)])]
    got = paths.covered_cells(spark.createDataFrame(lines, "k long, points array<struct<x:double,y:double>>"), ["k"], 4.0).collect()

    def inside(x, y):
        t = max(0, min(1, (x * 40 + y * 33) / (40**2 + 33**2)))
        return ((x - 40 * t) ** 2 + (y - 33 * t) ** 2) ** 0.5 <= 2

    grid = [(x, y) for x in range(-9, 60) for y in range(-9, 60)]
    cells = lambda k: {(r.cx, r.cy) for r in got if r.k == k}
    assert cells(1) == {c for c in grid if inside(*c)} and cells(3) == set()
    assert cells(2) == {(x, y) for x, y in grid if (x - 5) ** 2 + (y - 5) ** 2 <= 16} and cells(4) == {(x, y) for x, y in grid if (x - 0.5) ** 2 + (y - 2) ** 2 <= 4}


def test_fallback_numbers_count_single_items(spark):
    rows = [(1, 7, (0.0, 0.0, 5.0, 5.0)), (2, 7, (300.0, 300.0, 305.0, 305.0)), (3, 7, (320.0, 300.0, 325.0, 305.0)), (4, 7, (321.0, 300.0, 330.0, 305.0))]
    d = spark.createDataFrame(rows, "id long, page long, box struct<x0:double,y0:double,x1:double,y1:double>")
    r = panels.fallback_frames(d, spark.createDataFrame([(4,)], "id long"), 340.0, 900.0).collect()
    assert [(x.frame_id, x.objects, x.score, tuple(x.box)) for x in r] == [(100002, 2, 2.9, (278.0, 278.0, 340.0, 327.0))]


def test_first_panel_and_payload(spark):
    g = spark.createDataFrame([(1, 1, 5.0, 5.0, None, None), (2, 1, None, None, 10.4, 5.0), (3, 1, None, None, None, None), (4, 2, 5.0, 5.0, None, None)], "gcp_id long, page long, anchor_x double, anchor_y double, label_x double, label_y double")
    p = spark.createDataFrame([("b", 1, 2, (0.0, 0.0, 20.0, 20.0)), ("a", 1, 1, (0.0, 0.0, 10.0, 10.0))], "panel string, panel_page long, ordinal long, box struct<x0:double,y0:double,x1:double,y1:double>")
    assert sorted((r.gcp_id, r.panel) for r in panels.first_panel(g, p).collect()) == [(1, "a"), (2, "a")]
    pairs = spark.createDataFrame([([([1.23456, 2.0], None), ([1.23456, 2.0], [133.123456789, 34.0])],)], "pairs array<struct<px:array<double>,lonlat:array<double>>>")
    got = json.loads(pairs.select(F.to_json(panels.save_payload(F.col("pairs"), F.array(F.lit(1.0)), F.lit(2.34567))).alias("j")).first().j)
    assert got == {"control_points": [{"index": 1, "pdf_image_px": {"x": 1.235, "y": 2.0}, "map_lonlat": [133.1234568, 34.0]}], "corners_lonlat": [1.0], "rmse_m": 2.346}


def test_features_logs_and_reports(spark, tmp_path):
    s = spark.createDataFrame([("r", 0, 1.0, 2.0, 3.0, "path", True, True, 0.5, 1.5, 2.5, 9), ("r", 1, 1.0, 2.0, 3.0, None, False, True, 0.01, 1.5, 2.5, 9), ("r", 2, 1.0, 2.0, 3.0, None, False, False, 7.0, None, None, 9)],
                              "route_id string, sample_index int, lon double, lat double, nearest_m double, highway string, failed boolean, snapped boolean, snap_m double, snap_lon double, snap_lat double, way_id long")
    assert [json.loads(r.value)["geometry"] for r in writers.snap_links(s).collect()] == [{"type": "LineString", "coordinates": [[1.0, 2.0], [1.5, 2.5]]}]
    assert json.loads(writers.worst_points(s).first().value)["geometry"] == {"type": "Point", "coordinates": [1.0, 2.0]}
    text = writers.report("Run", {"Objects": 3}, {"Highways": writers.counts(s, "highway")})
    assert text == "# Run\n\n- Objects: `3`\n\n## Highways\n- : `2`\n- path: `1`\n"
    writers.write_log(spark, {"objects": 3, "page": "六"}, str(tmp_path / "log"))
    assert json.loads(spark.read.text(str(tmp_path / "log"), wholetext=True).where("value <> ''").first()[0]) == {"objects": 3, "page": "六"}
    fit = spark.createDataFrame([("c", 1, "n", 1.0, 2.0, None, None, 0.0, 0.0), ("c", 2, "n", 1.0, 2.0, 3.0, 4.0, 0.0, 0.0)], "combo string, index int, name string, lon double, lat double, fit_lon double, fit_lat double, fit_m double, loocv_m double")
    assert writers.residual_links(fit).count() == 1
