"""Rules of labels, frames, diagnoses, corners, rasters and raw readers on small made-up cases."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.functions import line, rect, text
from routeloom.operators import corners, graph, joins, labels, lookups, raster, rules
from routeloom.operators.fit import Transform
from routeloom.sources import raw, readers

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def box(*v):
    return rect.rect(*[F.lit(float(x)) for x in v])


def test_text_lines(spark):
    rows = [(1, 2, "b ", (5.0, 1.0, 9.0, 3.0), 7, 9.0), (1, 1, " a", (0.0, 0.0, 4.0, 2.0), 8, 6.0), (1, 3, "  ", (0.0, 0.0, 99.0, 99.0), 7, 50.0), (1, 4, "c", (9.0, 0.0, 12.0, 2.0), 7, 6.0), (2, 1, "x", (0.0, 0.0, 1.0, 1.0), 3, 5.0), (2, 2, "y", (0.0, 0.0, 1.0, 1.0), 2, 5.0), (3, 1, None, None, None, None)]
    d = labels.text_lines(spark.createDataFrame(rows, f"line int, span_no int, text string, box {BOX}, color int, size double"), ["line"])
    got = {r.line: (r.text, tuple(r.box), r.color, r.font_size) for r in d.collect()}
    assert got == {1: ("ab c", (0.0, 0.0, 12.0, 3.0), 7, 9.0), 2: ("xy", (0.0, 0.0, 1.0, 1.0), 3, 5.0)}


def test_small_drawings(spark):
    rows = [(1, (0.0, 0.0, 28.0, 5.0), 1.0, "[ .02 3 ] 0"), (2, (0.0, 0.0, 28.1, 5.0), 1.0, ""), (3, (0.0, 0.0, 0.3, 5.0), 1.0, ""), (4, (0.0, 0.0, 2.0, 4.0), None, None)]
    got = {r.k: (r.x, r.y, r.route_like) for r in labels.small_drawings(spark.createDataFrame(rows, f"k int, box {BOX}, width double, dash string")).collect()}
    assert got == {1: (14.0, 2.5, True), 4: (1.0, 2.0, False)}


def test_number_labels(spark):
    texts = ["四国霊場第８８番", "四国霊場第89番", "四国別格霊場第 20 番奥の院", "四国別格霊場第21番", "第3番", None]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select(text.numbered(F.col("t")).alias("n"))
    assert [None if r.n is None else tuple(r.n) for r in d.collect()] == [("88", 88), None, ("bekkaku", 20), None, None, None]


def test_markers(spark):
    spots = spark.createDataFrame([(1, 1, 0.0, 0.0), (2, 1, 500.0, 0.0), (3, 2, 0.0, 0.0)], "label int, page int, x double, y double")
    black = [0.0, 0.0, 0.0]
    rows = [(1, 1, 4.0, 0.0, (2.0, -2.0, 6.0, 2.0), "f", black, None, 5, False), (2, 1, 9.0, 0.0, (7.0, -2.0, 11.0, 2.0), "f", black, None, 5, False), (3, 1, 20.0, 0.0, (18.0, -2.0, 22.0, 2.0), "f", black, None, 5, False), (4, 1, 541.0, 0.0, (521.0, -20.0, 561.0, 20.0), "x", None, None, 1, True)]
    markers = spark.createDataFrame(rows, f"marker int, page int, x double, y double, box {BOX}, kind string, fill array<double>, stroke array<double>, items int, route_like boolean")
    got = {r.label: r for r in labels.snap_to_markers(spots, markers).collect()}
    assert (got[1].marker_found, got[1].x, got[1].cluster, got[1].reason, got[1].marker_box.x1) == (True, 6.5, 2, "marker_snapped", 11.0)
    assert got[1].score == pytest.approx(3.6 + 1.1 + 1.0 + 1.1 + 0.3)
    assert (got[2].marker_found, got[2].x, got[2].reason) == (False, 500.0, "marker_score_low") and got[3].reason == "marker_not_found" and got[3].score == 0


def test_gazetteer(spark):
    d = spark.createDataFrame([(1, "88", 1, "竜ケ寺"), (2, "88", 1, "竜寺"), (3, "88", 9, "x"), (4, "88", 1, None)], "label int, group string, no int, name string")
    g = spark.createDataFrame([(10, "88", 1, "龍ヶ寺(奥)")], "entry int, group string, no int, t string").select("entry", "group", "no", text.aliases(F.col("t")).alias("aliases"))
    got = {r.label: (r.entry, r.exact, round(r.likeness, 3)) for r in labels.gazetteer_matches(d, g).collect()}
    assert got == {1: (10, True, 1.0), 2: (10, False, 0.8), 3: (None, False, 0.0), 4: (10, False, 0.0)}


def test_required_lookups(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, h double")
    assert sorted(map(tuple, lookups.required_join(left, right, ["k"], "height").collect())) == [(1, "a", 5.0), (2, "b", 6.0)]
    with pytest.raises(Exception, match="no height for 2"):
        lookups.required_join(left, right.where("k = 1"), ["k"], "height").collect()
    assert lookups.required_row(right, F.col("k") == 2, "page").h == 6.0
    with pytest.raises(KeyError, match="no page"):
        lookups.required_row(right, F.col("k") == 3, "page")
    rows = spark.createDataFrame([("1", "5.5"), ("", "6"), ("2", None)], "page_no string, page_height_pt string")
    assert [tuple(r) for r in lookups.page_heights(rows).collect()] == [(1, 5.5)]


def test_dominant_and_empty(spark):
    d = spark.createDataFrame([(1, "b"), (2, "a"), (3, "a"), (4, "b")], "n int, cause string")
    assert tuple(lookups.dominant(d, "cause", "n").first()) == ("b", 2)
    assert tuple(lookups.dominant(d.limit(0), "cause", "n").first()) == ("unknown", 0)


def test_assignment_prefers_small_then_high_score_then_near(spark):
    frames = spark.createDataFrame([(1, 1, (0.0, 0.0, 100.0, 100.0), 1), (2, 1, (0.0, 0.0, 50.0, 50.0), 1), (3, 1, (0.0, 0.0, 50.0, 50.0), 2), (4, 1, (300.0, 0.0, 310.0, 10.0), 1)], f"frame_id int, frame_page int, frame_box {BOX}, score int")
    items = spark.createDataFrame([(1, 1, (8.0, 8.0, 12.0, 12.0)), (2, 1, (280.0, 0.0, 290.0, 5.0)), (3, 1, (200.0, 0.0, 270.0, 1.0)), (4, 2, (8.0, 8.0, 12.0, 12.0)), (5, 1, (110.0, 0.0, 120.0, 4.0))], f"item_id int, page int, box {BOX}")
    got = {r.item_id: (r.frame_id, r.gap) for r in joins.assign_container(items, frames).collect()}
    assert got == {1: (3, 0.0), 2: (4, 10.0), 3: (None, None), 4: (None, None), 5: (1, 10.0)}


def test_frame_suppression(spark):
    c = spark.createDataFrame([(1, 1, (0.0, 0.0, 100.0, 100.0), True, False), (2, 1, (0.0, 0.0, 50.0, 100.0), False, True), (3, 1, (50.0, 0.0, 100.0, 100.0), False, False), (4, 1, (200.0, 0.0, 290.0, 100.0), True, False)], f"id int, page int, box {BOX}, pale_or_dark boolean, white_or_blue boolean")
    support = lambda **kv: spark.createDataFrame([(int(k[1:]), o) for k, v in kv.items() for o in v], "id int, object_id int")
    full = support(_1=range(8), _2=range(4), _3=range(4, 8), _4=range(8))
    assert [r.parent for r in graph.suppressed_parents(c, full).collect()] == [1]
    assert graph.suppressed_parents(c, support(_1=range(5), _2=range(3), _3=range(2, 5))).isEmpty()
    assert graph.suppressed_parents(c, support(_1=range(20), _2=range(9), _3=range(9, 12))).isEmpty()
    assert [r.parent for r in graph.redundant_parents(c, support(_1=range(8), _2=range(3), _3=range(3, 6))).collect()] == [1]
    assert graph.redundant_parents(c, support(_1=range(9), _2=range(3), _3=range(3, 5))).isEmpty()
    assert [r.child for r in graph.inner_legends(c, full).collect()] == [2]
    assert graph.inner_legends(c, support(_1=range(8), _2=[1, 99])).isEmpty()


def test_corners(spark):
    source = np.array([[10, 20], [110, 20], [110, 220], [10, 220]], float)
    target = np.array([[133.0, 34.0], [134.0, 34.1], [133.9, 33.0], [133.1, 33.2]])
    corner = lambda k: line.point(F.lit(float(target[k][0])), F.lit(float(target[k][1])))
    four = F.struct(*[corner(k).alias(n) for k, n in enumerate(("top_left", "top_right", "bottom_right", "bottom_left"))])
    pts = [(10.0, 20.0), (60.0, 120.0), (90.0, 30.0)]
    lines = F.array(F.array(*[line.point(F.lit(x), F.lit(y)) for x, y in pts]), F.array(line.point(F.lit(1.0), F.lit(1.0))))
    r = one(spark, corners.transform_lines(lines, box(10, 20, 110, 220), four).alias("t")).t
    assert len(r.lines) == 1 and r.issues == [] and np.allclose([tuple(p) for p in r.lines[0]], Transform("projective", source, target)(np.array(pts)), atol=1e-6)
    far = one(spark, corners.transform_lines(F.array(F.array(line.point(F.lit(9e3), F.lit(1.0)))), box(10, 20, 110, 220), four).alias("t")).t
    assert far.lines == [] and set(far.issues) == {"too_few_points", "out_of_shikoku_bounds"}


def test_previews(spark):
    panel = box(100, 100, 300, 200)
    spaces = [corners.coordinate_space(b, panel, F.lit(1000), F.lit(800)) for b in (box(100, 100, 300, 200), box(-40, 1, 150, 90), box(-1, 0, 20, 20), box(500, 10, 900, 700), box(5000, 0, 5001, 1), F.lit(None).cast(BOX))]
    assert list(one(spark, *spaces)) == ["page_pdf_pt", "unknown", "panel_local_pt", "image_px", "unknown", "unknown"]
    assert tuple(one(spark, corners.to_pixels(F.lit("page_pdf_pt"), F.lit(200.0), F.lit(150.0), panel, F.lit(1000), F.lit(800)).alias("p")).p) == (500.0, 400.0)
    no, yes = F.lit(False), F.lit(True)
    assert list(one(spark, *[corners.active_model(F.lit(a), x, y, F.lit(n)) for a, x, y, n in (("auto", yes, yes, 2), ("auto", yes, yes, 3), ("projective", yes, no, 5), ("affine", no, no, 5))])) == ["similarity", "affine", "affine", "similarity"]


def test_line_parts(spark):
    pts = lambda *v: F.array(*[line.point(F.lit(float(x)), F.lit(float(y))) for x, y in v])
    a, b = pts((0, 0), (10, 0), (10, 0), (10, 10)), pts((10, 10), (12, 10))
    r = one(spark, line.insert_index(a, F.lit(12.0), F.lit(5.0)).alias("near"), line.insert_index(a, F.lit(99.0), F.lit(5.0)).alias("far"), line.joined(F.array(a, b)).alias("j"), line.without_short(F.array(a, b)).alias("w"), F.size(line.segments_of(b)).alias("s"), F.size(line.segments_of(pts((1, 1)))).alias("none"))
    assert r.near == 3 and r.far is None and len(r.j) == 5 and len(r.w) == 1 and r.s == 1 and r.none == 0


def test_rasters(spark):
    px = spark.createDataFrame([(1, 5, 5, 200, 10, 10), (1, 7, 9, 140, 110, 105), (1, 9, 9, 140, 105, 105), (2, 1, 1, 0, 0, 0)], "page int, x int, y int, r int, g int, b int")
    assert [raster.red_mask(px, k).count() for k in raster.MASKS] == [3, 2, 1]
    assert raster.dilate(raster.red_mask(px, "overlay"), 5).count() == 25 and raster.dilate(raster.red_mask(px, "overlay"), 1).count() == 1
    bounds = raster.mask_bounds(raster.red_mask(px), 2, 10, 100)
    assert [tuple(r) for r in bounds.collect()] == [(1, 3, 3, 10, 12)] and raster.crop(px, bounds).count() == 3
    pts = spark.createDataFrame([(1, 1, 6.0, 6.0), (2, 2, 90.0, 90.0)], "route int, page int, x double, y double")
    assert {r.route: r.red_ratio for r in raster.red_share(pts, px, ["route"]).collect()} == {1: 1.0, 2: 0.0}
    with pytest.raises(ValueError, match="kind"):
        raster.red_mask(px, "other")


def test_edge_lines(spark):
    frame = box(0, 0, 200, 100)
    cases = [("walk_sub", (0, 95, 150, 99), 270.0), ("walk_main", (0, 95, 150, 99), 270.0), ("walk_sub", (0, 40, 150, 44), 270.0), ("walk_sub", (2, 10, 8, 90), 190.0)]
    assert list(one(spark, *[rules.edge_line(F.lit(s), box(*b), F.lit(n), frame) for s, b, n in cases])) == [True, False, False, True]
    assert one(spark, rules.edge_line(F.lit("walk_sub"), box(0, 95, 150, 99), F.lit(300.0), F.lit(None).cast(BOX)).alias("e")).e is False


def test_raw_readers(spark, tmp_path):
    near, far = [237 / 255, 28 / 255, 36 / 255], [0.0, 0.0, 1.0]
    rows = [{"page_no": 1, "draw_index": k, "color": c, "fill": f, "rect": {"x0": 0, "y0": 0, "x1": 1, "y1": 1}} for k, (c, f) in enumerate([(near, None), (far, None), (far, near), (None, None)])]
    (tmp_path / "drawings.json").write_text("\n".join(map(json.dumps, rows)))
    assert [r.draw_index for r in raw.red_drawings(raw.read_drawings(spark, str(tmp_path / "drawings.json"))).orderBy("draw_index").collect()] == [0, 2]
    (tmp_path / "spans.json").write_text(json.dumps({"page_no": 1, "line_no": 2, "span_no": 1, "text": "x", "box": {"x0": 1, "y0": 1, "x1": 2, "y1": 2}, "size": 5}))
    assert labels.text_lines(raw.read_spans(spark, str(tmp_path / "spans.json")), ["page_no", "line_no"]).first().text == "x"
    feature = {"type": "Feature", "properties": {"segment_id": "s1", "page_no": 3, "frame_id": "", "style_class": "walk_main", "review_reasons": "a,,b"}, "geometry": {"type": "LineString", "coordinates": [[1, -2], [3, 4]]}}
    (tmp_path / "seg.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    s = raw.raw_segments(readers.read_geojson(spark, str(tmp_path / "seg.geojson"))).first()
    assert (s.segment_id, s.page_no, s.frame_id, s.review_reasons, tuple(s.points[0]), s.needs_manual_review) == ("s1", 3, None, ["a", "b"], (100.0, 200.0), False)


def test_saved_georefs_and_settings(spark, tmp_path):
    folder = tmp_path / "georef"
    folder.mkdir()
    body = lambda x: json.dumps({"page_no": 1, "georef_panel_id": "p1", "corners_lonlat": {"top_left": [x, 34.0]}, "pdf_frame_bbox": {"x0": 0, "y0": 0, "x1": 1, "y1": 1}})
    (folder / "page_001_a.json").write_text(body(133.0))
    (folder / "page_001_b.json").write_text(body(134.0))
    (folder / "page_002_x.json").write_text("{oops")
    (folder / "page_003_x.json").write_text("{}")
    d = raw.read_saved_georefs(spark, str(folder)).select(raw.saved_corner("top_left").alias("c"), corners.panel_box(F.col("pdf_panel_bbox"), F.col("pdf_frame_bbox"), F.col("frame.bbox_pt"), F.lit("9;9;9;9")).alias("b"))
    assert [(tuple(r.c), r.b.x1) for r in d.collect()] == [((134.0, 34.0), 1.0)]
    (tmp_path / ".env").write_text("# note\nA = 'x'\nB=2\nbroken\n")
    assert raw.read_settings(str(tmp_path / ".env"), {"B": "3"}) == {"A": "x", "B": "3"} and raw.read_settings(str(tmp_path / "none")) == {}
    assert raw.first_existing(None, "/nowhere", str(tmp_path)) == str(tmp_path) and raw.first_existing("/nowhere") is None


def test_parallel_lines_and_anchor_heights(spark, tmp_path):
    rows = [(1, 1, (0.0, 0.0, 300.0, 4.0), 300.0, "walk_sub"), (2, 1, (10.0, 3.0, 290.0, 8.0), 280.0, "walk_sub"), (3, 1, (0.0, 0.0, 300.0, 4.0), 249.0, "walk_sub"), (4, 1, (0.0, 0.0, 300.0, 30.0), 300.0, "walk_sub"), (5, 1, (0.0, 0.0, 300.0, 4.0), 300.0, "walk_main"), (6, 2, (0.0, 0.0, 300.0, 4.0), 300.0, "walk_sub")]
    d = spark.createDataFrame(rows, f"id int, page int, box {BOX}, length double, style string")
    assert [tuple(r) for r in joins.parallel_lines(d).collect()] == [(1, 2)]
    anchor = {"index": 1, "role": "frame_anchor", "pdf_x": 1, "longitude": 133, "latitude": 34.0}
    for name, frame, gcps in (("page_061_061_f06.json", "061_f06", [anchor]), ("page_061_061_f07.json", "061_f07", [{**anchor, "role": "check"}])):
        (tmp_path / name).write_text(json.dumps({"page_no": 61, "frame_id": frame, "gcps": gcps}))
    status = lambda heights: {r.frame_id: (r.status, r.page_height) for r in readers.read_anchor_files(spark, str(tmp_path), heights).collect()}
    assert status(None) == {"061_f06": ("skipped_no_page_height", None), "061_f07": ("skipped_no_frame_anchor", None)}
    assert status(spark.createDataFrame([(61, 700.0)], "page_no int, page_height double"))["061_f06"] == ("imported", 700.0)


def test_nearest_segment_of_far_and_empty(spark):
    pts = spark.createDataFrame([(1, 0.0, 1.0), (2, 5000.0, 0.0), (3, -9000.0, 50.0)], "point_id long, x double, y double")
    seg = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 0.0), (2, 4000.0, 0.0, 4100.0, 0.0)], "segment_id long, ax double, ay double, bx double, by double")
    got = {r.point_id: (r.segment_id, round(r.distance, 3)) for r in joins.nearest_segment(pts, seg, 50.0).collect()}
    assert got == {1: (1, 1.0), 2: (2, 900.0), 3: (1, round((9000**2 + 50**2) ** 0.5, 3))}
    assert joins.nearest_segment(pts, seg.limit(0), 50.0).count() == 0
