"""Queries over path items, fallback frames, covered cells, panels and exported features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.functions import line, rect
from routeloom.operators import panels, paths
from routeloom.plans.base import control_points, frames, points, table, with_
from routeloom.sources import writers


def _items(spark, sf_dir) -> DataFrame:
    """A drawing an order, an item a line number; most strokes go on where the last number ended."""
    c = F.col
    d = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("draw"), c("l_linenumber").cast("long").alias("seq")).agg(F.min("l_partkey").alias("part"))
    d = d.withColumn("op", F.when(c("part") % 9 == 0, "re").when(c("part") % 9 == 1, "qu").when(c("part") % 9 == 2, "h").when(c("part") % 9 < 5, "c").otherwise("l"))
    at = lambda k: line.point(((c("draw") * 7919 + k * 131) % 400).cast("double"), ((c("draw") * 104729 + k * 57) % 300).cast("double"))
    start, end = at(c("seq") - F.when(c("part") % 4 == 0, 9).otherwise(0)), at(c("seq") + 1)
    middle = (at(c("part")), at(c("part") + 3))
    pts = F.when(c("op") == "h", F.array().cast(paths.EMPTY)).when(c("op").isin("l", "re"), F.array(start, end)).otherwise(F.array(start, *middle, end))
    return d.select("draw", "seq", "op", pts.alias("pts"))


def path_metrics(spark, sf_dir):
    d = paths.path_metrics(_items(spark, sf_dir), ["draw"])
    return d.select("draw", F.round("length", 3).alias("length"), "segments", "curves", "closed")


def separate_lines(spark, sf_dir):
    d = paths.separate_lines(_items(spark, sf_dir), ["draw"])
    return d.select("draw", "seq", F.size("points").alias("vertices"), F.round(line.length(F.col("points")), 3).alias("length"))


def joined_lines(spark, sf_dir):
    d = paths.joined_lines(_items(spark, sf_dir), ["draw"])
    return d.select("draw", "line_no", F.size("points").cast("long").alias("vertices"), F.round(line.length(F.col("points")), 3).alias("length"))


_ITEMS = """WITH raw AS (SELECT l_orderkey AS draw, l_linenumber::bigint AS seq, min(l_partkey) AS part FROM lineitem GROUP BY 1, 2),
    named AS (SELECT *, CASE WHEN part % 9 = 0 THEN 're' WHEN part % 9 = 1 THEN 'qu' WHEN part % 9 = 2 THEN 'h' WHEN part % 9 < 5 THEN 'c' ELSE 'l' END AS op, seq - CASE WHEN part % 4 = 0 THEN 9 ELSE 0 END AS s FROM raw),
    xy AS (SELECT draw, seq, op, [(draw * 7919 + k * 131) % 400 FOR k IN [s, part, part + 3, seq + 1]]::double[] AS x, [(draw * 104729 + k * 57) % 300 FOR k IN [s, part, part + 3, seq + 1]]::double[] AS y FROM named),
    own AS (SELECT draw, seq, op, x[1] AS sx, y[1] AS sy, x[4] AS ex, y[4] AS ey, CASE op WHEN 'l' THEN 2 WHEN 'c' THEN 17 WHEN 'h' THEN 0 ELSE 5 END AS n, CASE op WHEN 'h' THEN 0
      WHEN 'l' THEN sqrt(pow(x[4] - x[1], 2) + pow(y[4] - y[1], 2)) WHEN 're' THEN 2 * (abs(x[4] - x[1]) + abs(y[4] - y[1]))
      WHEN 'qu' THEN list_sum([sqrt(pow(x[k % 4 + 1] - x[k], 2) + pow(y[k % 4 + 1] - y[k], 2)) FOR k IN [1, 2, 3, 4]])
      ELSE list_sum([sqrt(pow(pow(1-(k+1)/16.0::double,3)*x[1] + 3*pow(1-(k+1)/16.0::double,2)*((k+1)/16.0::double)*x[2] + 3*(1-(k+1)/16.0::double)*pow((k+1)/16.0::double,2)*x[3] + pow((k+1)/16.0::double,3)*x[4]
        - pow(1-k/16.0::double,3)*x[1] - 3*pow(1-k/16.0::double,2)*(k/16.0::double)*x[2] - 3*(1-k/16.0::double)*pow(k/16.0::double,2)*x[3] - pow(k/16.0::double,3)*x[4], 2)
        + pow(pow(1-(k+1)/16.0::double,3)*y[1] + 3*pow(1-(k+1)/16.0::double,2)*((k+1)/16.0::double)*y[2] + 3*(1-(k+1)/16.0::double)*pow((k+1)/16.0::double,2)*y[3] + pow((k+1)/16.0::double,3)*y[4]
        - pow(1-k/16.0::double,3)*y[1] - 3*pow(1-k/16.0::double,2)*(k/16.0::double)*y[2] - 3*(1-k/16.0::double)*pow(k/16.0::double,2)*y[3] - pow(k/16.0::double,3)*y[4], 2)) FOR k IN range(16)]) END AS len FROM xy),
    numbered AS (SELECT *, op IN ('l', 'c') AS stroke, coalesce(sum((op NOT IN ('l', 'c'))::int) OVER (PARTITION BY draw ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS path FROM own),
    traced AS (SELECT *, first_value(CASE WHEN stroke THEN sx END IGNORE NULLS) OVER w AS bx, first_value(CASE WHEN stroke THEN sy END IGNORE NULLS) OVER w AS by_, last_value(CASE WHEN stroke THEN ex END IGNORE NULLS) OVER w AS px, last_value(CASE WHEN stroke THEN ey END IGNORE NULLS) OVER w AS py
      FROM numbered WINDOW w AS (PARTITION BY draw, path ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    back AS (SELECT *, op = 'h' AND px IS NOT NULL AND (px <> bx OR py <> by_) AS returns, sqrt(pow(px - bx, 2) + pow(py - by_, 2)) AS way FROM traced)"""


def fallback_frames(spark, sf_dir):
    f = frames(spark, sf_dir).select("id", "page", "box")
    d = panels.fallback_frames(f, f.where("id % 2 = 0"), 1000.0, 700.0)
    return d.select("page", "frame_id", "objects", F.round("score", 4).alias("score"), "box.x0", "box.y0", "box.x1", "box.y1")


_FALLBACK = """, f AS (SELECT * FROM frames WHERE id % 2 <> 0), e AS (SELECT a.id AS a, b.id AS b FROM f a JOIN f b ON a.page = b.page AND a.id <> b.id AND sqrt(pow(greatest(0, a.x0 - b.x1, b.x0 - a.x1), 2) + pow(greatest(0, a.y0 - b.y1, b.y0 - a.y1), 2)) <= 34),
    r AS (SELECT id AS node, id AS reach FROM f UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a), c AS (SELECT node, min(reach) AS component FROM r GROUP BY 1),
    g AS (SELECT page, component, count(*) AS objects, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM c JOIN f ON id = node GROUP BY 1, 2),
    n AS (SELECT *, 100000 + row_number() OVER (PARTITION BY page ORDER BY component) AS frame_id FROM g)
    SELECT page, frame_id, objects, round(2.5::double + objects * 0.2::double, 4) AS score, greatest(0.0::double, x0 - 22) AS x0, greatest(0.0::double, y0 - 22) AS y0, least(1000.0::double, x1 + 22) AS x1, least(700.0::double, y1 + 22) AS y1 FROM n WHERE objects >= 2"""


def covered_cells(spark, sf_dir):
    """Cells a page's lines cover; every eleventh line is one point."""
    f = frames(spark, sf_dir)
    at = lambda x, y: line.point((F.col(x) % 300).cast("double"), (F.col(y) % 200).cast("double"))
    d = f.select("page", F.when(F.col("id") % 11 == 0, F.array(at("x0", "y0"))).otherwise(F.array(at("x0", "y0"), at("x1", "y0"), at("y1", "x0"))).alias("points"))
    return paths.covered_cells(d, ["page"]).groupBy("page").agg(F.count("*").alias("cells"), F.sum(F.col("cx") * 1000 + F.col("cy")).alias("digest"))


_CELLS = """, p AS (SELECT page, id, x0 % 300 AS ax, y0 % 200 AS ay, x1 % 300 AS bx, y0 % 200 AS by_, y1 % 300 AS dx, x0 % 200 AS dy FROM frames),
    s AS (SELECT page, ax, ay, bx, by_, 3 AS r FROM p WHERE id % 11 <> 0 UNION SELECT page, bx, by_, dx, dy, 3 FROM p WHERE id % 11 <> 0 UNION SELECT page, ax, ay, ax, ay, 6 FROM p WHERE id % 11 = 0),
    m AS (SELECT s.*, cx, cy, CASE WHEN pow(bx - ax, 2) + pow(by_ - ay, 2) <= 1e-12 THEN 0 ELSE greatest(0, least(1, ((cx - ax) * (bx - ax) + (cy - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) END AS t FROM s, range(-10, 310) x(cx), range(-10, 310) y(cy)
      WHERE cx BETWEEN least(ax, bx) - r AND greatest(ax, bx) + r AND cy BETWEEN least(ay, by_) - r AND greatest(ay, by_) + r)
    SELECT page, count(*) AS cells, sum(cx * 1000 + cy)::bigint AS digest FROM (SELECT DISTINCT page, cx, cy FROM m WHERE round(sqrt(pow(cx - ax - t * (bx - ax), 2) + pow(cy - ay - t * (by_ - ay), 2)), 6) <= r) GROUP BY 1"""


def _panels(spark, sf_dir) -> DataFrame:
    f = frames(spark, sf_dir)
    k = F.col
    box = rect.rect((k("x0") % 600) - 40, k("y0") - 40, (k("x0") % 600) + 60, k("y1") + 40)
    return f.select(k("id").alias("panel"), (k("page") % 25).alias("panel_page"), (k("id") * 7919 % 1009).alias("ordinal"), box.alias("box"))


def first_panel(spark, sf_dir):
    g = control_points(spark, sf_dir)
    d = g.select(F.col("gcp").alias("gcp_id"), F.col("page_no").alias("page"), *[F.when(F.col("gcp") % 3 > 0, F.col(c)).alias(f"anchor_{c}") for c in "xy"], F.when(F.col("gcp") % 5 > 0, F.col("x") + 5).alias("label_x"), F.when(F.col("gcp") % 5 > 0, F.col("y") + 5).alias("label_y"))
    return panels.first_panel(d, _panels(spark, sf_dir))


_PANELS = """, panels AS (SELECT id AS panel, page % 25 AS panel_page, id * 7919 % 1009 AS ordinal, x0 % 600 - 40 AS x0, y0 - 40 AS y0, x0 % 600 + 60 AS x1, y1 + 40 AS y1 FROM frames),
    g AS (SELECT gcp AS gcp_id, page_no AS page, coalesce(CASE WHEN gcp % 3 > 0 THEN x END, CASE WHEN gcp % 5 > 0 THEN x + 5 END) AS x, coalesce(CASE WHEN gcp % 3 > 0 THEN y END, CASE WHEN gcp % 5 > 0 THEN y + 5 END) AS y FROM gcps),
    hit AS (SELECT gcp_id, page, panel, x, y FROM g JOIN panels ON page = panel_page AND x BETWEEN x0 - 0.5 AND x1 + 0.5 AND y BETWEEN y0 - 0.5 AND y1 + 0.5 QUALIFY row_number() OVER (PARTITION BY gcp_id ORDER BY ordinal, panel) = 1)"""


def panel_manifest(spark, sf_dir):
    """Every panel with its routes, saved georeference and control points, as one JSON text."""
    routes = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 150).alias("panel"), F.col("o_orderkey").alias("route_id"), F.col("o_orderstatus").alias("status"))
    saved = table(spark, sf_dir, "supplier").groupBy((F.col("s_suppkey") * 3).alias("panel")).agg(F.min("s_nationkey").alias("saved_nation"))
    got = first_panel(spark, sf_dir)
    base = _panels(spark, sf_dir).select("panel", "panel_page")
    d = panels.manifest(base, routes=panels.nested(routes, "panel", "routes", "route_id", "status"), saved=saved, gcps=panels.nested(got, "panel", "gcps", "gcp_id"))
    return d.select("panel", F.to_json(F.struct("panel_page", F.size("routes").alias("route_count"), "routes", "saved_nation", "gcps")).alias("manifest"))


_MANIFEST = """, r AS (SELECT o_custkey % 150 AS panel, list({'route_id': o_orderkey, 'status': o_orderstatus} ORDER BY o_orderkey, o_orderstatus) AS routes FROM orders GROUP BY 1),
    s AS (SELECT s_suppkey * 3 AS panel, min(s_nationkey) AS nation FROM supplier GROUP BY 1), h AS (SELECT panel, list({'gcp_id': gcp_id} ORDER BY gcp_id) AS gcps FROM hit GROUP BY 1)
    SELECT p.panel, '{"panel_page":' || panel_page || ',"route_count":' || coalesce(len(routes), 0) || ',"routes":' || coalesce(to_json(routes), '[]') || CASE WHEN nation IS NULL THEN '' ELSE ',"saved_nation":' || nation END || ',"gcps":' || coalesce(to_json(gcps), '[]') || '}' AS manifest
    FROM panels p LEFT JOIN r ON r.panel = p.panel LEFT JOIN s ON s.panel = p.panel LEFT JOIN h ON h.panel = p.panel"""


def anchor_features(spark, sf_dir):
    k = F.col("event_id")
    d = points(spark, sf_dir).select(k.alias("index"), F.col("event_type").alias("name"), (k % 90 + 0.5).alias("lon"), (k % 80 + 0.25).alias("lat"), (k % 90 + 0.75).alias("fit_lon"), (k % 80 + 0.5).alias("fit_lat"))
    return writers.anchor_features(d)


_ANCHORS = """WITH a AS (SELECT event_id AS index, '{"type":"Feature","properties":{"index":' || event_id || ',"name":"' || event_type || '","point_kind":"' AS head,
    '[' || (event_id % 90 + 0.5)::double || ',' || (event_id % 80 + 0.25)::double || ']' AS here, '[' || (event_id % 90 + 0.75)::double || ',' || (event_id % 80 + 0.5)::double || ']' AS there FROM events)
    SELECT index, 0::int AS part, head || 'target"},"geometry":{"type":"Point","coordinates":' || here || '}}' AS value FROM a UNION ALL SELECT index, 1, head || 'fit_pred"},"geometry":{"type":"Point","coordinates":' || there || '}}' FROM a
    UNION ALL SELECT index, 2, head || 'residual_vector"},"geometry":{"type":"LineString","coordinates":[' || here || ',' || there || ']}}' FROM a"""


def panel_collections(spark, sf_dir):
    k = F.col("o_orderkey")
    at = lambda m: line.point((k % 90 + m).cast("double"), (k % 80).cast("double"))
    d = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 100).alias("panel"), k.alias("route_id"), F.when(k % 7 == 0, F.array(at(0))).otherwise(F.array(at(0), at(1))).alias("points"))
    return writers.panel_collections(d)


_COLLECTIONS = """SELECT o_custkey % 100 AS panel, '{"type":"FeatureCollection","features":[' || string_agg('{"type":"Feature","properties":{"panel":' || (o_custkey % 100) || ',"route_id":' || o_orderkey || '},"geometry":{"type":"LineString","coordinates":[[' || (o_orderkey % 90)::double || ',' || (o_orderkey % 80)::double || '],['
    || (o_orderkey % 90 + 1)::double || ',' || (o_orderkey % 80)::double || ']]}}', ',' ORDER BY o_orderkey) || ']}' AS value FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY 1"""

QUERIES = {f.__name__: f for f in (path_metrics, separate_lines, joined_lines, fallback_frames, covered_cells, first_panel, panel_manifest, anchor_features, panel_collections)}
ORACLES = {
    "path_metrics": _ITEMS + " SELECT draw, round(sum(len), 3) AS length, sum(CASE WHEN op IN ('re', 'qu') THEN 4 WHEN op = 'h' THEN 0 ELSE 1 END)::bigint AS segments, count(*) FILTER (op = 'c') AS curves, count(*) FILTER (NOT stroke) AS closed FROM numbered GROUP BY 1",
    "separate_lines": _ITEMS + " SELECT draw, seq, CASE WHEN returns THEN 2 ELSE n END::int AS vertices, round(CASE WHEN returns THEN way ELSE len END, 3) AS length FROM back WHERE n > 0 OR returns",
    "joined_lines": _ITEMS + """, split AS (SELECT *, op IN ('re', 'qu') OR (stroke AND (px IS NULL OR px <> sx OR py <> sy)) AS fresh FROM back), lines AS (SELECT *, sum(fresh::int) OVER (PARTITION BY draw ORDER BY seq)::bigint AS line_no FROM split)
        SELECT draw, line_no, sum(CASE WHEN returns THEN 1 WHEN stroke AND NOT fresh THEN n - 1 ELSE n END)::bigint AS vertices, round(sum(CASE WHEN returns THEN way ELSE len END), 3) AS length FROM lines WHERE n > 0 OR returns GROUP BY 1, 2""",
    "fallback_frames": with_("frames", _FALLBACK, recursive=True),
    "covered_cells": with_("frames", _CELLS),
    "first_panel": with_("frames gcps", _PANELS + " SELECT * FROM hit"),
    "panel_manifest": with_("frames gcps", _PANELS + _MANIFEST),
    "anchor_features": _ANCHORS,
    "panel_collections": _COLLECTIONS,
}
