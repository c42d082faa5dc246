"""Crowded pages: operators that meet by place, against plain loops and against their general forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from routeloom.operators import graph, joins, tiles

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def boxes(n, seed, side=60, pages=2, width=200):
    rng = np.random.default_rng(seed)
    at, size = rng.integers(0, width, (n, 2)).astype(float), rng.integers(1, side, (n, 2))
    return [(k, k % pages, (float(x), float(y), float(x + w), float(y + h))) for k, ((x, y), (w, h)) in enumerate(zip(at, size, strict=True))]


def test_point_counts():
    rng = np.random.default_rng(5)
    x, y, w = rng.integers(0, 30, 400).astype(float), rng.integers(0, 30, 400).astype(float), rng.integers(1, 4, 400)
    a, b = rng.integers(-5, 35, (2, 2, 200)).astype(float)
    want = [int(w[(x >= p) & (x <= r) & (y >= q) & (y <= s)].sum()) for p, q, r, s in zip(a[0], a[1], b[0], b[1], strict=True)]
    assert tiles.PointCounts(x, y, w).inside(a[0], a[1], b[0], b[1]).tolist() == want
    assert tiles.PointCounts(x[:0], y[:0]).inside(a[0], a[1], b[0], b[1]).sum() == 0


@pytest.mark.parametrize("kind", ["suppressed_parents", "redundant_parents", "inner_legends"])
def test_support_by_dots_is_support(spark, kind):
    c = spark.createDataFrame([(*r, r[0] % 3 < 2, r[0] % 2 == 0) for r in boxes(160, 3, 110)], f"id long, page long, box {BOX}, pale_or_dark boolean, white_or_blue boolean")
    rng = np.random.default_rng(8)
    dots = spark.createDataFrame([(k, k % 2, float(x), float(y)) for k, (x, y) in enumerate(rng.integers(0, 250, (500, 2)))], "object_id long, page long, x double, y double")
    held = c.join(dots, "page").where("x between box.x0 and box.x1 and y between box.y0 and box.y1").select("id", "object_id")
    want = sorted(r[0] for r in getattr(graph, kind)(c, held).collect())
    frame = getattr(graph, f"{kind}_of_dots")(c, dots)
    assert sorted(r[0] for r in frame.collect()) == want and 2 < len(want) < 155
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_cells_of_many_lines_on_one_spot(spark):
    from routeloom.operators import paths

    rng = np.random.default_rng(11)
    ends = [((3.0, 4.0), (3.0, 30.0)), ((0.0, 7.0), (25.0, 7.0)), ((5.0, 5.0), (5.0, 5.0))] + [tuple(map(tuple, e)) for e in rng.integers(0, 40, (60, 2, 2)).astype(float).tolist() + rng.uniform(0, 40, (20, 2, 2)).tolist()]
    want = {}
    grid = np.stack(np.meshgrid(np.arange(-10, 55), np.arange(-10, 55), indexing="ij"), -1).reshape(-1, 2).astype(float)
    for k, (a, b) in enumerate(ends):
        d = np.subtract(b, a)
        t = np.clip((grid - a) @ d / (d @ d), 0, 1) if d @ d > 1e-12 else np.zeros(len(grid))
        away = np.hypot(*(grid - a - t[:, None] * d).T)
        want.setdefault(k % 3, set()).update(map(tuple, grid[np.round(away, 6) <= 3].astype(int).tolist()))
    lines = spark.createDataFrame([(k % 3, [a, b]) for k, (a, b) in enumerate(ends)] * 3, "k long, points array<struct<x:double,y:double>>")
    got = paths.covered_cells(lines, ["k"])
    rows = got.collect()
    assert len(rows) == len(set(rows)) and {(r.k, r.cx, r.cy) for r in rows} == {(k, *c) for k, cells in want.items() for c in cells}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") > plan.index("Window")  # merged as stretches, not as cells


def table_of(spark, rows, *names):
    return spark.createDataFrame([r[: 3] for r in rows], f"{names[0]} long, {names[1]} long, {names[2]} {BOX}")


def apart(a, b):
    return np.hypot(max(0, a[0] - b[2], b[0] - a[2]), max(0, a[1] - b[3], b[1] - a[3]))


def test_pairs_and_components(spark):
    rows = boxes(90, 6, 12)
    d = table_of(spark, rows, "id", "page", "box")
    want = {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] == b[1] and apart(a[2], b[2]) <= 5}
    frame = joins.rect_pairs(d, 5.0)
    got = [(r.a, r.b) for r in frame.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()
    top = {r[0]: r[0] for r in rows}
    for _ in rows:
        for a, b in want:
            top[a] = top[b] = min(top[a], top[b])
    found = graph.touching(d, 5.0)
    assert dict(map(tuple, found.collect())) == top
    assert graph.touching(d.unionByName(d), 5.0).count() == len(rows)


def test_fallback_frames_of_crowded_pages(spark):
    from routeloom.operators import panels

    rows = boxes(900, 31, 30, width=2500)  # many components
    d = table_of(spark, rows, "id", "page", "box")
    frame = panels.fallback_frames(d, d.where("id % 5 = 0"), 2000.0, 2400.0)
    left = [r for r in rows if r[0] % 5]
    top = {r[0]: r[0] for r in left}
    links = [(a[0], b[0]) for a in left for b in left if a[0] < b[0] and a[1] == b[1] and apart(a[2], b[2]) <= 34]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if top[a] != top[b]:
                top[a] = top[b] = min(top[a], top[b])
                changed = True
    want = set()
    for page in (0, 1):
        for k, c in enumerate(sorted({top[r[0]] for r in left if r[1] == page}), 1):
            held = [r[2] for r in left if top[r[0]] == c]
            if len(held) >= 2:
                low, high = (lambda n: max(0.0, min(b[n] for b in held) - 22)), (lambda n, end: min(end, max(b[n] for b in held) + 22))  # noqa: B023
                want.add((page, 100_000 + k, len(held), round(2.5 + 0.2 * len(held), 4), low(0), low(1), high(2, 2000.0), high(3, 2400.0)))
    got = {(r.page, r.frame_id, r.objects, round(r.score, 4), *r.box) for r in frame.collect()}
    assert got == want and len(want) > 50
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert all("LeftAnti" in line for line in plan.splitlines() if "Join" in line)


def test_containers_with_large_items(spark):
    frames = [(k, p, b, k % 5) for k, p, b in boxes(50, 1, 30)]
    items = [(k, p, b) for k, p, b in boxes(120, 2, 6, width=260)] + [(500, 0, (0.0, 0.0, 150.0, 150.0)), (501, 7, (0.0, 0.0, 1.0, 1.0))]
    want = {}
    for k, p, b in items:
        cx, cy = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2
        able = []
        for i, q, f, s in frames:
            if p == q:
                held, area = f[0] <= cx <= f[2] and f[1] <= cy <= f[3], (f[2] - f[0]) * (f[3] - f[1])
                able.append((-1, area, -s, i) if held else (apart(b, f), area, 0, i))
        best = min(able, default=(99,))
        want[k] = (best[3], pytest.approx(max(0, best[0]))) if best[0] <= 24 else (None, None)
    f = spark.createDataFrame(frames, f"frame_id long, frame_page long, frame_box {BOX}, score long")
    d = joins.assign_container(table_of(spark, items, "item_id", "page", "box"), f)
    assert {r.item_id: (r.frame_id, r.gap) for r in d.collect()} == want


def test_points_inside(spark):
    rows, dots = boxes(60, 9, 40), np.random.default_rng(1).integers(0, 220, (300, 2)).tolist()
    d = joins.points_inside(table_of(spark, rows, "id", "page", "box"), spark.createDataFrame([(k % 2, float(x), float(y)) for k, (x, y) in enumerate(dots)], "page long, x double, y double"))
    want = {i: sum(p == k % 2 and b[0] <= x <= b[2] and b[1] <= y <= b[3] for k, (x, y) in enumerate(dots)) for i, p, b in rows}
    assert dict(map(tuple, d.collect())) == {k: n for k, n in want.items() if n}
    assert "Join" not in d._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["frame_score", "candidate_gates"])
def test_counts_of_routes_are_not_joined(spark, name):
    from conftest import SMALL

    from routeloom.plans.queries import QUERIES

    assert "Join" not in QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_all_frames_with_points_inside(spark):
    rows = [(1, 0, (0.0, 0.0, 5.0, 5.0)), (1, 1, (0.0, 0.0, 5.0, 5.0)), (2, 0, (50.0, 50.0, 60.0, 60.0)), (3, None, (0.0, 0.0, 9.0, 9.0)), (4, 0, None), (5, 9, (0.0, 0.0, 9.0, 9.0))]
    dots = spark.createDataFrame([(0, 1.0, 5.0), (1, 2.0, 2.0), (1, 3.0, 3.0), (None, 1.0, 1.0), (0, None, 1.0)], "page long, x double, y double")
    d = joins.with_points_inside(table_of(spark, rows, "id", "page", "box").withColumn("kept", F.col("id") * 2), dots, "n")
    assert sorted((r.id, r.kept, r.n) for r in d.collect()) == [(1, 2, 3), (1, 2, 3), (2, 4, 0), (3, 6, 0), (4, 8, 0), (5, 10, 0)]


def test_cover_by_dots_is_cover(spark):
    c = table_of(spark, boxes(80, 4, 90), "id", "page", "box").withColumn("score", (F.col("id") % 7).cast("double")).withColumn("area", F.col("box.x1") - F.col("box.x0"))
    dots = spark.createDataFrame([(k, k % 2, float(x), float(y)) for k, (x, y) in enumerate(np.random.default_rng(8).integers(0, 250, (200, 2)).tolist())], "object_id long, page long, x double, y double")
    held = c.join(dots, "page").where("x between box.x0 and box.x1 and y between box.y0 and box.y1").groupBy("id").agg(F.collect_set("object_id").alias("objects"))
    want = sorted(map(tuple, graph.greedy_cover(c.join(held, "id")).collect()))
    assert sorted(map(tuple, graph.greedy_cover_of_dots(c, dots).collect())) == want and len(want) > 10


def test_cover_of_a_page_that_is_soon_covered(spark):
    import time

    box = lambda x: F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), x.alias("x1"), F.lit(9.0).alias("y1"))
    many = spark.range(200_000).select(F.lit(0).cast("long").alias("page"), "id", (F.col("id") % 1000).cast("double").alias("score"), F.lit(7.0).alias("area"), box(F.when(F.col("id") % 1000 == 3, 3.0).otherwise(9.0)).alias("box"))
    dots = spark.createDataFrame([(0, float(k), 1.0) for k in range(8)], "page long, x double, y double")
    began = time.perf_counter()
    rows = graph.greedy_cover_of_dots(many, dots).orderBy("picked_order").collect()
    took = time.perf_counter() - began
    want = sorted((k for k in range(200_000) if k % 1000 > 3), key=lambda k: (-(k % 1000), k))  # ends with the first that holds four
    assert [r.id for r in rows] == want and [r.new_objects for r in rows] == [8] + [0] * (len(want) - 1)
    assert [r.picked_order for r in rows] == list(range(len(want))) and took < 8


def test_best_overlap(spark):
    small, large = boxes(50, 12, 12), boxes(40, 13, 50)
    want = {}
    for k, p, a in small:
        share = lambda b: max(0, min(a[2], b[2]) - max(a[0], b[0])) * max(0, min(a[3], b[3]) - max(a[1], b[1])) / ((a[2] - a[0]) * (a[3] - a[1]))  # noqa: B023, E731
        best = max(((share(b), -i) for i, q, b in large if p == q))
        if best[0] >= 0.25:
            want[k] = -best[1]
    d = joins.best_overlap(table_of(spark, small, "label", "page", "box"), table_of(spark, large, "id", "page", "box"), 0.25)
    assert {r.label: r.id for r in d.collect()} == want and len(want) > 5
    assert "Join" not in d._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["nearest_segment", "road_summary", "marker_cluster", "reading_labels", "name_group_top1", "first_panel", "panel_manifest", "frame_score", "fallback_frames", "rect_components"])
def test_no_pairs_become_rows(spark, name):
    from conftest import SMALL

    from routeloom.plans.queries import QUERIES

    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        assert "NestedLoop" not in line and "CartesianProduct" not in line
        if "Join" in line:  # joins left are by key alone
            assert not any(test in line for test in (" <= ", " >= ", " < ", "HYPOT"))


@pytest.fixture
def sent(monkeypatch):
    """How many right rows went to tiles, in order of the joins."""
    counts, by_tile = [], tiles.by_tile

    def counted(left, right, *rest):
        counts.append(right.count())
        return by_tile(left, right, *rest)

    monkeypatch.setattr(tiles, "by_tile", counted)
    return counts


def test_first_panel_of_crowded_pages(spark, sent):
    from routeloom.operators import panels

    held = [(k, p, k * 37 % 11, b) for k, p, b in boxes(400, 21, 60, width=150)]
    dots = [(k, k % 3, None if k % 7 == 0 else float(x), float(y)) for k, (x, y) in enumerate(np.random.default_rng(3).integers(-10, 240, (300, 2)).tolist())]
    points = spark.createDataFrame([(*d, d[2] and d[2] + 1, d[3]) for d in dots], "gcp_id long, page long, anchor_x double, anchor_y double, label_x double, label_y double")
    d = panels.first_panel(points, spark.createDataFrame(held, f"panel long, panel_page long, ordinal long, box {BOX}"))
    want = {}
    for k, page, x, y in dots:
        able = [(o, i) for i, p, o, b in held if p == page and x is not None and b[0] - 0.5 <= x <= b[2] + 0.5 and b[1] - 0.5 <= y <= b[3] + 0.5]
        if able:
            want[k] = min(able)[1]
    assert {r.gcp_id: r.panel for r in d.collect()} == want and 50 < len(want) < 200
    assert sent[0] <= 4 * len(held)


def test_readings_of_crowded_pages(spark, sent):
    from routeloom.operators import labels

    rows = [(k, k % 2, k % 3 // 2, float(x), float(y), k * 5 % 3, k * 7 % 4) for k, (x, y) in enumerate(np.random.default_rng(4).integers(0, 300, (600, 2)).tolist())]
    names, readings = rows[:200], rows[150:]  # some are both
    frame = lambda d: spark.createDataFrame(d, "label long, page long, frame long, x double, y double, color long, size long")
    want = {}
    for a in names:
        able = []
        for b in readings:
            away = np.sqrt((a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2)
            if a[0] != b[0] and a[1:3] == b[1:3] and away <= 26:
                able.append((max(0.0, 24.0 - away) / 10.0 + (1.0 if a[5] == b[5] else 0.0) + (0.3 if b[6] < a[6] else 0.0), -b[0]))
        if able and max(able)[0] > 0.7:
            want[a[0]] = (-max(able)[1], pytest.approx(max(able)[0]))
    got = {r.name: (r.reading, r.score) for r in labels.reading_of(frame(names), frame(readings)).collect()}
    assert got == want and len(want) > 100
    assert sent[0] <= 4 * len(readings)


def test_nearest_brings_columns_along(spark):
    from conftest import SMALL

    from routeloom.plans.queries import QUERIES

    pts = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 1.0), ("b", 9.0, 1.0), ("c", 900.0, 1.0), ("d", None, 1.0)], "who string, x double, y double")
    seg = spark.createDataFrame([(7, 0.0, 0.0, 2.0, 0.0, "path"), (8, 9.0, 0.0, 9.0, 0.0, None)], "segment_id long, ax double, ay double, bx double, by double, kind string")
    got = joins.nearest_segment(pts, seg, 5.0, ["who", "kind", "distance"])
    assert got.columns == ["who", "kind", "distance"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [("a", "path", 1.0), ("a", "path", 1.0), ("b", None, 1.0), ("c", None, float(np.hypot(891, 1))), ("d", None, None)]))
    assert joins.nearest_segment(pts, seg.limit(0), 5.0, ["who", "kind", "distance"]).columns == got.columns
    assert "Join" not in QUERIES["road_summary"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


def test_places_at_a_shared_corner_are_the_same_from_both_ends(spark):
    from routeloom.operators import windows

    pts = [(1, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (10.0, 0.0), (10.0, 0.0), (20.0, 5.0), (30.0, 5.0)])] + [(2, 0, 0.0, 0.0), (2, 1, 1.0, 0.0), (3, 0, 0.0, 0.0)]
    d = spark.createDataFrame(pts, "k long, i long, x double, y double")
    got = {r.k: (r.n, r.place, r.back) for r in windows.nearest_places(d, ["k"], ["i"], 10.0, -3.0, 5.0).collect()}
    assert got == {1: (5, 1, 4), 2: (2, None, None), 3: (1, None, None)}


def test_insertion_into_crowded_lines(spark, duck, tmp_path):
    import duckdb
    from parity import rows_of

    from routeloom.plans.queries import ORACLES, QUERIES

    path = f"{tmp_path}/customer.parquet"
    duck.sql(f"COPY (SELECT c.* REPLACE (c_custkey + i * 150 AS c_custkey, (c_nationkey % 2)::int AS c_nationkey) FROM range(40) r(i), customer c) TO '{path}' (FORMAT parquet)")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{path}')")
    assert rows_of(QUERIES["insertion"](spark, str(tmp_path)).toPandas()) == rows_of(con.sql(ORACLES["insertion"]).df())
