import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.functions import color, geo, line, rect, text
from routeloom.operators import fit, graph, joins, windows


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_rectangles(spark):
    box = lambda *v: rect.rect(*[F.lit(float(x)) for x in v])
    a, b, c = box(0, 0, 10, 10), box(5, 5, 15, 15), box(13, 14, 20, 20)
    r = one(spark, rect.iou(a, b).alias("ab"), rect.iou(b, a).alias("ba"), rect.gap(a, c).alias("gap"), rect.contains(a, box(1, 1, 2, 2)).alias("inside"), rect.overlap_ratio(a, b).alias("part"), rect.iou(box(0, 0, 0, 0), a).alias("none"))
    assert r.ab == r.ba == pytest.approx(25 / 175) and r.gap == 5.0 and r.inside and r.part == 0.25 and r.none == 0.0


def test_colours(spark):
    red, grey = F.array(F.lit(0.9), F.lit(0.1), F.lit(0.1)), F.array(F.lit(0.5))
    r = one(spark, color.l1_distance(red, color.rgb(grey)).alias("d"), color.l1_distance(red, F.lit(None).cast("array<double>")).alias("n"), color.hex_of(F.lit(255)).alias("h"), color.near_white(F.lit(None).cast("array<double>")).alias("w"))
    assert r.d == pytest.approx(1.2) and r.n is None and r.h == "#0000ff" and r.w is False


def test_geography(spark):
    r = one(spark, geo.haversine_m(F.lit(133.0), F.lit(33.0), F.lit(133.0), F.lit(34.0)).alias("m"), geo.segment_offset(*[F.lit(float(v)) for v in (5, 5, 0, 0, 0, 0)]).alias("p"), geo.turn_score(*[F.lit(float(v)) for v in (1, 0, 0, 2)]).alias("c"))
    assert r.m == pytest.approx(math.radians(1) * geo.EARTH_M) and r.p.t == 0 and r.p.distance == pytest.approx(50**0.5) and r.c == 0


def test_lines(spark):
    p = lambda x, y: line.point(F.lit(float(x)), F.lit(float(y)))
    pts = F.array(p(0, 0), p(3, 4), p(3, 5))
    r = one(spark, line.length(pts).alias("a"), line.length(F.reverse(pts)).alias("b"), line.length(F.array(p(1, 1))).alias("one"), F.size(line.bezier(p(0, 0), p(1, 0), p(2, 0), p(3, 0))).alias("n"), line.geojson_geometry(F.array(pts)).alias("g"), line.geojson_geometry(F.array(pts, pts)).alias("m"))
    assert r.a == r.b == 6.0 and r.one == 0 and r.n == 17 and '"LineString"' in r.g and '"MultiLineString"' in r.m


def test_texts(spark):
    r = one(
        spark, text.normalized(F.lit("圓龍ヶ （１２）")).alias("n"), text.number_in(F.lit("四国霊場第１２番")).alias("no"), text.last_part(F.lit("四国 大窪寺（奥）")).alias("last"), text.whole_number(F.lit("61.0")).alias("w"),
        text.rect_text(F.lit("1;2;3;x")).alias("r"), text.add_reason(F.lit("a|b"), "b", "|").alias("a"), text.truth(F.lit(" TRUE ")).alias("t"), F.size(text.aliases(F.lit("ヶ"))).alias("al"),
    )
    assert (r.n, r.no, r.last, r.w, r.r.x1, r.r.y1, r.a, r.t, r.al) == ("円竜ケ(12)", 12, "大窪寺", 0, 3.0, None, "a|b", True, 2)


def test_runs_end_with_their_key(spark):
    d = spark.createDataFrame([(1, k, v) for k, v in enumerate([9, 9, 0, 9])] + [(2, 0, 9), (2, 1, 9)], "k long, i long, v long")
    assert sorted(tuple(r) for r in windows.runs(d, ["k"], ["i"], F.col("v") > 5).collect()) == [(1, 1, 2, 2), (2, 1, 2, 2)]


def test_leave_one_out_matches_refitting(spark):
    rng = np.random.default_rng(4)
    s = rng.uniform(0, 500, (7, 2))
    z = (s @ [1, 1j]) * (2 + 0.3j) + rng.normal(0, 3, 7)
    rows = [(1, float(a), float(b), float(w.real), float(w.imag)) for (a, b), w in zip(s, z, strict=True)]
    d = spark.createDataFrame(rows, "k long, x double, y double, u double, v double")
    got = math.sqrt(np.mean([r.error**2 for r in windows.leave_one_out(d, ["k"]).collect()]))
    numeric = {r.model: r for r in fit.fit_numeric(d, ["k"]).collect()}
    assert got == pytest.approx(numeric["similarity"].loocv, rel=1e-9)
    assert fit.fit_similarity(d, ["k"]).first().rmse == pytest.approx(numeric["similarity"].rmse, rel=1e-9)
    assert fit.fit_affine(d, ["k"]).first().rmse == pytest.approx(numeric["affine"].rmse, rel=1e-6)
    assert "polynomial2" not in numeric  # seven points are too few


def test_projective_is_exact_on_corners():
    s = np.array([[0, 0], [10, 0], [10, 8], [0, 8]], float)
    t = np.array([[1, 1], [9, 2], [12, 11], [0, 7]], float)
    assert np.allclose(fit.Transform("projective", s, t)(s), t)


def test_selection_switches_only_for_a_clear_gain(spark):
    rows = [("a", "similarity", "y_flipped", "local_equirect_m", 8, 30.0, 40.0), ("a", "affine", "y_flipped", "local_equirect_m", 8, 20.0, 30.0), ("b", "similarity", "y_flipped", "local_equirect_m", 8, 30.0, 45.0), ("b", "affine", "y_flipped", "local_equirect_m", 8, 9.0, 20.0), ("c", "similarity", "raw_y", "local_equirect_m", 3, 1.0, 1.0)]
    d = spark.createDataFrame(rows, "scope_id string, model string, y_mode string, crs string, n long, rmse double, loocv double")
    assert {r.scope_id: r.model for r in fit.select_models(d).collect()} == {"a": "similarity", "b": "affine"}


def test_nearest_segment_is_global(spark):
    rng = np.random.default_rng(2)
    p = [(i, *map(float, rng.uniform(-900, 900, 2))) for i in range(60)] + [(99, 5000.0, 5000.0)]
    s = [(i, *map(float, rng.uniform(-60, 60, 4))) for i in range(25)]
    got = {r.point_id: r.distance for r in joins.nearest_segment(spark.createDataFrame(p, "point_id long, x double, y double"), spark.createDataFrame(s, "segment_id long, ax double, ay double, bx double, by double"), 20.0).collect()}

    def away(x, y, ax, ay, bx, by):
        t = max(0.0, min(1.0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))

    assert got == {i: pytest.approx(min(away(x, y, *q[1:]) for q in s)) for i, x, y in p}


def test_graph_operators(spark):
    seg = [(1, 0, 0.0, 0.0, 10.0, 0.0), (1, 1, 11.0, 1.0, 20.0, 0.0), (1, 2, 20.0, 0.5, 20.0, 9.0), (1, 3, 20.0, 0.0, 30.0, 0.0)]
    d = spark.createDataFrame(seg, "page long, segment long, x0 double, y0 double, x1 double, y1 double")
    nodes = graph.snap_nodes(d, 3.0)
    edges = nodes.join(d, ["page", "segment"])
    chains = {r.segment: r.chain for r in graph.build_chains(edges).collect()}
    assert chains[0] == chains[1] and len({chains[0], chains[2], chains[3]}) == 3
    assert [r.degree for r in graph.branch_nodes(edges).collect()] == [3]
    box = [(1, 1, 9.0, 0.0, 0.0, 100.0, 100.0), (1, 2, 5.0, 1.0, 1.0, 100.0, 100.0), (1, 3, 7.0, 300.0, 0.0, 400.0, 100.0)]
    kept = graph.greedy_dedupe(spark.createDataFrame(box, "page long, id long, score double, x0 double, y0 double, x1 double, y1 double"))
    assert {r.id: r.kept_order for r in kept.collect()} == {1: 0, 3: 1}
    cover = spark.createDataFrame([(1, 1, 1.0, 0.0, [1, 2, 3]), (1, 2, 0.0, 0.0, [3, 4, 5]), (1, 3, 0.0, 0.0, [1])], "page long, id long, score double, area double, objects array<long>")
    assert [(r.id, r.new_objects) for r in graph.greedy_cover(cover).orderBy("picked_order").collect()] == [(1, 3), (2, 2)]


def test_merge_prefers_manual_groups(spark):
    a = spark.createDataFrame([(1, "x", "auto"), (2, "x", "auto")], "p long, f string, s string")
    m = spark.createDataFrame([(1, "x", "manual")], "p long, f string, s string")
    assert sorted((r.p, r.s) for r in joins.merge_preferred(a, m, ["p", "f"]).collect()) == [(1, "manual"), (2, "auto")]


# Six anchors on a page, and the error that leaving each out gives.
ANCHORS = [
    (713.267, 581.189, 133.7926461, 34.2140322), (932.258, 521.31, 133.7774733, 34.2268695), (925.849, 662.453, 133.7894231, 34.2322742),
    (970.715, 672.076, 133.7882674, 34.2350036), (844.662, 667.799, 133.7936487, 34.2264629), (607.51, 662.453, 133.8043977, 34.2097731),
]


def test_golden_anchors(spark):
    rows = [(61, "061_f06", x, y, lon, lat, 1.0, "manual", 728.5040283203125) for x, y, lon, lat in ANCHORS]
    d = spark.createDataFrame(rows, "page_no long, frame_id string, x double, y double, lon double, lat double, confidence double, source string, page_height double")
    points = fit.candidate_points(fit.scopes(d)).where("scope_type = 'frame'")
    keys = ["scope_id", "y_mode", "crs"]
    best = fit.select_models(fit.similarity_candidates(points, keys)).first()
    assert best.loocv == pytest.approx(35.97, abs=0.01) and best.status == "pass"
    best = fit.select_models(fit.fit_numeric(points, keys)).first()
    assert (best.model, best.y_mode, best.crs) == ("similarity", "y_flipped", "local_equirect_m")
