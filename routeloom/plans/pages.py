"""Queries over drawings, rectangles, labels and reviews of pages."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeloom.functions import rect, text
from routeloom.operators import graph, joins, labels, rules
from routeloom.plans.base import drawings, frames, table, with_

GAP = 34.0


def _classified(spark, sf_dir) -> DataFrame:
    c = F.col
    d = drawings(spark, sf_dir)
    return d.withColumn("class", rules.object_class(c("draw_type"), c("fill_distance"), c("dash"), c("width"), c("box_w"), c("box_h"), c("path"), c("closed"), c("segments")))


CLASSIFIED = """, classified AS (SELECT *, CASE WHEN draw_type = 'fs' OR fill_distance IS NOT NULL THEN 'filled_symbol_or_legend' WHEN box_w < 14 AND box_h < 14 AND path < 40 THEN 'small_symbol_or_label'
    WHEN dash <> 'solid' AND width BETWEEN 0.8 AND 2.4 AND path >= 20 THEN 'red_dashed_nonroute' WHEN dash <> 'solid' THEN 'annotation_dashed' WHEN box_w > 120 AND box_h < 40 AND path < 300 THEN 'legend_like'
    WHEN closed > 0 AND box_w >= 18 AND box_h >= 18 AND path <= 2 * (box_w + box_h) + 12 THEN 'red_annotation_solid' WHEN width BETWEEN 0.8 AND 2.4 AND path >= 15 AND segments >= 1 THEN 'red_solid_route'
    WHEN path >= 10 THEN 'red_annotation_solid' ELSE 'unknown_red' END AS class FROM drawings)"""


def classify_objects(spark, sf_dir):
    return _classified(spark, sf_dir).groupBy("class").agg(F.count("*").alias("objects"), F.round(F.sum(F.round("path", 2)), 1).alias("total_length"))


def page_histogram(spark, sf_dir):
    pages = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 70).alias("page")).distinct()
    d = _classified(spark, sf_dir).groupBy("page", "class").agg(F.count("*").alias("objects"))
    return pages.join(d, "page", "left").select("page", F.coalesce("class", F.lit("none")).alias("class"), F.coalesce("objects", F.lit(0)).alias("objects"))


def top_pages(spark, sf_dir):
    d = _classified(spark, sf_dir).groupBy("page").agg(F.round(F.sum(F.round("path", 2)), 1).alias("total_length"), F.count("*").alias("objects"))
    return d.orderBy(F.desc("total_length"), F.desc("objects"), "page").limit(25)


def _scored(spark, sf_dir) -> DataFrame:
    """Frames with the routes in and around them and their score."""
    f = frames(spark, sf_dir)
    d = _classified(spark, sf_dir).where(F.col("class") == rules.ROUTE_CLASS).select((F.col("page") % 32).alias("page"), F.col("px").alias("x"), F.col("py").alias("y"))
    wide = rect.rect(F.col("x0") - 60, F.col("y0") - 60, F.col("x1") + 60, F.col("y1") + 60)
    s = joins.with_points_inside(f.select("id", "page", "x0", "y0", "x1", "y1", wide.alias("box")), d, "routes")
    k = F.col("id")
    shade = lambda m: ((k * m) % 101) / F.lit(100.0)
    fill = F.when(k % 2 == 0, F.array(*[0.7 + 0.3 * shade(m) for m in (3, 3, 5)]))
    stroke = F.array(*[0.6 * shade(m) for m in (7, 7, 11)])
    score = rules.frame_score(F.col("x1") - F.col("x0") + 120, F.col("y1") - F.col("y0") + 120, F.when(k % 3 == 0, "f").otherwise("s"), stroke, fill, (k % 20) / 10.0, F.col("routes"), k % 5 > 0, k % 9, F.lit(595.0), F.lit(842.0))
    return s.withColumn("score", F.round(score, 4))


def frame_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("id", "routes", "score")


_SHADE = lambda m: f"((id * {m}) % 101) / 100.0::double"
_FRAME_SCORE = f""", hits AS (SELECT f.id, count(*) AS routes FROM frames f JOIN classified d ON f.page = d.page % 32 AND d.class = 'red_solid_route' AND d.px BETWEEN x0 - 60 AND x1 + 60 AND d.py BETWEEN y0 - 60 AND y1 + 60 GROUP BY 1),
    s AS (SELECT f.id, coalesce(routes, 0) AS routes, x1 - x0 + 120 AS w, y1 - y0 + 120 AS h, CASE WHEN f.id % 3 = 0 THEN 'f' ELSE 's' END AS dt, (f.id % 20) / 10.0::double AS sw, f.id % 5 > 0 AS rl, f.id % 9 AS cx, f.id % 2 = 0 AS hasfill,
      0.7::double + 0.3::double * {_SHADE(3).replace('id', 'f.id')} AS f1, 0.7::double + 0.3::double * {_SHADE(5).replace('id', 'f.id')} AS f3, 0.6::double * {_SHADE(7).replace('id', 'f.id')} AS s1, 0.6::double * {_SHADE(11).replace('id', 'f.id')} AS s3 FROM frames f LEFT JOIN hits ON f.id = hits.id),
    m AS (SELECT *, (f1 + f1 + f3) / 3 AS fm, greatest(f1, f3) - least(f1, f3) AS fs, (s1 + s1 + s3) / 3 AS sm FROM s),
    n AS (SELECT *, hasfill AND fm >= 0.985 AND fs <= 0.03 AS white FROM m)
    SELECT id, routes, round(CASE WHEN hasfill AND least(f1, f3) >= 0.75 AND fm >= 0.82 AND NOT white THEN 3.0 ELSE 0 END + CASE WHEN sm <= 0.28 AND sw >= 1.2 THEN 2.5 WHEN sm <= 0.28 AND sw >= 0.3 THEN 1.5 ELSE 0 END
      + CASE WHEN s3 >= 0.65 AND s1 <= 0.2 AND s1 <= 0.75 AND sw >= 1.0 THEN 0.8 ELSE 0 END + CASE WHEN rl THEN 0.6 ELSE 0 END + CASE WHEN dt = 'f' AND cx >= 6 THEN 0.6 ELSE 0 END
      + least(routes, 40) * 0.18::double + least(routes / greatest(w * h, 1.0) * 120000.0::double, 1.6::double) + CASE WHEN white THEN -1.5 ELSE 0 END + CASE WHEN w > 595 * 0.95 AND h > 842 * 0.4 THEN -2.0 ELSE 0 END
      + CASE WHEN w / h > 5.5 OR w / h < 0.18 THEN -1.5 ELSE 0 END + CASE WHEN cx <= 2 AND NOT rl THEN -2.5 ELSE 0 END + CASE WHEN routes = 0 THEN -3.0 ELSE 0 END, 4) AS score FROM n"""


_GAP_SQL = "sqrt(pow(greatest(0, a.x0 - b.x1, b.x0 - a.x1), 2) + pow(greatest(0, a.y0 - b.y1, b.y0 - a.y1), 2))"


def rect_pairs_iou(spark, sf_dir):
    p = joins.rect_pairs(frames(spark, sf_dir).select("id", "page", "box"), 0.0)
    return p.select("a", "b", F.round("iou", 6).alias("iou"), F.round("overlap", 6).alias("overlap"))


_BOTH = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
_AREA = "(({0}.x1 - {0}.x0) * ({0}.y1 - {0}.y0))"


def assign_frame(spark, sf_dir):
    items = drawings(spark, sf_dir).groupBy("draw", "line").agg(F.min("page").alias("p"), F.min("px").alias("x"), F.min("py").alias("y"))
    box = rect.rect(F.col("x"), F.col("y"), F.col("x") + 6, F.col("y") + 4)
    items = items.select((F.col("draw") * 10 + F.col("line")).alias("item_id"), (F.col("p") % 32).alias("page"), box.alias("box"))
    f = frames(spark, sf_dir).select(F.col("id").alias("frame_id"), F.col("page").alias("frame_page"), F.col("box").alias("frame_box"), (F.col("id") % 97).alias("score"))
    return joins.assign_container(items, f).select("item_id", F.coalesce("frame_id", F.lit(-1)).alias("frame_id"), F.round("gap", 6).alias("gap"))


def overlap_assign(spark, sf_dir):
    f = frames(spark, sf_dir)
    d = joins.best_overlap(f.where("size <= 12").select(F.col("id").alias("label"), "page", "box"), f.where("size > 12").select("id", "page", "box"), 0.25)
    return d.select("label", F.col("id").alias("frame_id"), F.round("share", 6).alias("share"))


def frame_numbering(spark, sf_dir):
    f = frames(spark, sf_dir)
    w = F.row_number().over(Window.partitionBy("page").orderBy("y0", "x0", F.desc(rect.area(F.col("box"))), "id"))
    return f.withColumn("n", w).select("id", F.format_string("%03d_f%02d", F.col("page"), F.col("n")).alias("frame_name"))


def _supported(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """(candidates (id, page, box, area, pale_or_dark, white_or_blue), dots (page, object_id, x, y)): widened rectangles with the areas of the narrow ones, and the centres that support what holds them."""
    f = frames(spark, sf_dir)
    m = F.col("size") * 6.0
    c = f.select("id", "page", rect.rect(F.col("x0") - m, F.col("y0") - m, F.col("x1") + m, F.col("y1") + m).alias("box"), rect.area(F.col("box")).alias("area"), (F.col("id") % 3 < 2).alias("pale_or_dark"), (F.col("id") % 2 == 0).alias("white_or_blue"))
    return c, f.select("page", F.col("id").alias("object_id"), ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))


_SUPPORT = """, cand AS (SELECT id, page, x0 - 6.0::double * size AS x0, y0 - 6.0::double * size AS y0, x1 + 6.0::double * size AS x1, y1 + 6.0::double * size AS y1 FROM frames),
    held AS (SELECT c.id, d.id AS o FROM cand c JOIN frames d ON c.page = d.page AND (d.x0 + d.x1) / 2 BETWEEN c.x0 AND c.x1 AND (d.y0 + d.y1) / 2 BETWEEN c.y0 AND c.y1),
    sup AS (SELECT c.*, (x1 - x0) * (y1 - y0) AS area, n FROM cand c JOIN (SELECT id, count(DISTINCT o) AS n FROM held GROUP BY 1) USING (id))"""
_INSIDE = "a.x0 - {0} <= b.x0 AND a.y0 - {0} <= b.y0 AND a.x1 + {0} >= b.x1 AND a.y1 + {0} >= b.y1"


def parent_suppress(spark, sf_dir):
    return graph.suppressed_parents_of_dots(*_supported(spark, sf_dir)).select(F.col("parent").alias("suppressed"))


def redundant_suppress(spark, sf_dir):
    return graph.redundant_parents_of_dots(*_supported(spark, sf_dir)).select(F.col("parent").alias("suppressed"))


def legend_suppress(spark, sf_dir):
    return graph.inner_legends_of_dots(*_supported(spark, sf_dir)).select(F.col("child").alias("suppressed"))


def rect_components(spark, sf_dir):
    f = frames(spark, sf_dir)
    c = graph.touching(f.select("id", "page", "box"), GAP)
    d = c.join(f, "id").groupBy("component").agg(F.count("*").alias("members"), *[fn(k).alias(k) for fn, k in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))])
    return d


def greedy_dedupe(spark, sf_dir):
    f = frames(spark, sf_dir).select((F.col("page") % 4).alias("page"), "id", (F.col("id") % 97).cast("double").alias("score"), "x0", "y0", "x1", "y1")
    return graph.greedy_dedupe(f, overlap=0.2, edge=12.0)


def frame_merge(spark, sf_dir):
    f = frames(spark, sf_dir).select((F.col("page") % 4).alias("page"), "id", (F.col("id") % 97).cast("double").alias("score"), F.col("size").alias("objects"), "x0", "y0", "x1", "y1")
    return graph.merge_frames(f, overlap=0.2)


def greedy_cover(spark, sf_dir):
    c, dots = _supported(spark, sf_dir)
    return graph.greedy_cover_of_dots(c.withColumn("score", (F.col("id") % 7).cast("double")), dots)


def _edges(spark, sf_dir) -> DataFrame:
    p = F.col("p_partkey")
    c = lambda m, n: ((p * m) % n).cast("double")
    s = table(spark, sf_dir, "part").select((p % 16).alias("page"), p.alias("segment"), c(7919, 61).alias("x0"), c(104729, 53).alias("y0"), c(1299709, 61).alias("x1"), c(15485863, 53).alias("y1"))
    return graph.snap_nodes(s, 6.5).join(s, ["page", "segment"])


def snap_nodes(spark, sf_dir):
    return _edges(spark, sf_dir).select("page", "segment", "node_a", "node_b")


def build_chains(spark, sf_dir):
    return graph.build_chains(_edges(spark, sf_dir))


def _keyed_edges(spark, sf_dir) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select((p % 16).alias("page"), ((p * 7919) % 97).alias("node_a"), ((p * 104729) % 89).alias("node_b"))


def branch_nodes(spark, sf_dir):
    return graph.branch_nodes(_keyed_edges(spark, sf_dir))


def segment_confidence(spark, sf_dir):
    c = F.col
    score, reasons = rules.segment_confidence(c("class"), c("width"), c("path") - 15, c("draw") % 3 > 0)
    d = _classified(spark, sf_dir).select(F.round(score, 4).alias("confidence"), F.array_join(reasons, ",").alias("reasons"))
    return d.groupBy("confidence", "reasons").agg(F.count("*").alias("segments"))


_SEGCONF = """, sc AS (SELECT *, draw % 3 > 0 AS framed, path - 15 AS len FROM classified), cf AS (SELECT page, draw, class, least(greatest(0.58::double + CASE WHEN class = 'red_solid_route' THEN 0.16::double ELSE 0 END + CASE WHEN class = 'red_solid_route' AND width BETWEEN 0.9 AND 2.2 THEN 0.08::double ELSE 0 END
    + CASE WHEN len >= 40 THEN 0.06::double WHEN len < 10 THEN -0.16::double ELSE 0 END + CASE WHEN framed THEN 0 ELSE -0.18::double END, 0), 0.98::double) AS confidence, len < 10 AS short, NOT framed AS unframed FROM sc)"""


def component_confidence(spark, sf_dir):
    c = F.col
    score, reasons = rules.segment_confidence(c("class"), c("width"), c("path") - 15, c("draw") % 3 > 0)
    d = _classified(spark, sf_dir).withColumn("confidence", score).withColumn("low", F.size(reasons) > 0).withColumn("component", c("draw") % 500)
    g = d.groupBy("component").agg(F.avg("confidence").alias("mean"), F.bool_or("low").alias("low"), F.count("*").alias("n"), F.count_if(c("class") == rules.ROUTE_CLASS).alias("routes"))
    total, why = rules.component_confidence(c("mean"), c("n") % 3, c("n") % 4, c("component") % 5 == 0, c("low"), c("component") % 7 == 0, c("component") % 11 == 0)
    style = F.when(c("routes") * 2 >= c("n"), "walk_main").otherwise("unknown_red")
    return g.select("component", F.round(total, 4).alias("confidence"), F.array_join(why, "|").alias("reasons"), style.alias("style"))


def _flat_segments(spark, sf_dir) -> DataFrame:
    k = F.col("id")
    f = frames(spark, sf_dir)
    box = rect.rect(F.col("x0"), F.col("y0"), F.col("x0") + 20 + 6 * F.col("size"), F.col("y0") + k % 26)
    return f.select(k, (F.col("page") % 4).alias("page"), box.alias("box"), (200.0 + 5 * F.col("size")).alias("length"), F.when(k % 5 > 0, "walk_sub").otherwise("walk_main").alias("style"))


def parallel_duplicates(spark, sf_dir):
    return joins.parallel_lines(_flat_segments(spark, sf_dir))


def name_group_top1(spark, sf_dir):
    """Number labels with their best name label: near, of like colour, scored by distance."""
    f = frames(spark, sf_dir).select("id", "page", "size", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y"))
    def score(away, high, a, b):
        s = np.maximum(0.0, 36 - away) / 12 + np.where(a["size"] % 3 == b["size"] % 3, 1.6, 0.0) + np.where(b["size"] % 4 == 1, 2.0, 0.0)
        return np.where(np.abs(high) <= 38, np.round(s, 6), -np.inf)

    f = f.withColumnRenamed("id", "label")
    d = labels.best_partners(f.where("size % 4 = 0"), f.where("size % 4 > 0"), ["page"], 54.0, score, ["size"])
    return d.select(F.col("name").alias("number"), F.col("other").alias("name"), F.round("score", 6).alias("score")).where("score > 1.0")


_NAMES = """, l AS (SELECT id, page, size, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM frames), s AS (SELECT a.id AS number, b.id AS name, round(greatest(0.0::double, 36 - sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) / 12
    + CASE WHEN a.size % 3 = b.size % 3 THEN 1.6::double ELSE 0 END + CASE WHEN b.size % 4 = 1 THEN 2.0::double ELSE 0 END, 6) AS score FROM l a JOIN l b ON a.page = b.page AND a.size % 4 = 0 AND b.size % 4 > 0 AND sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 54 AND abs(a.y - b.y) <= 38)
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY number ORDER BY score DESC, name) = 1 AND score > 1.0"""


def marker_cluster(spark, sf_dir):
    """Labels with the cluster of small drawings around their best marker."""
    f, k = frames(spark, sf_dir), F.col("id")
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    spots = f.select(k, (F.col("page") % 2).alias("page"), x.alias("x"), y.alias("y"))
    shade = lambda m: F.array(((k * m) % 10) / 10.0, ((k * 3) % 10) / 10.0, ((k * 7) % 10) / 10.0)
    half = (k % 20 + 1) / 2.0
    markers = spots.where("id % 5 > 0").select(
        k.alias("marker"), "page", "x", "y", rect.rect(F.col("x") - half, F.col("y") - half, F.col("x") + half, F.col("y") + half).alias("box"),
        F.when(k % 3 == 0, "f").when(k % 3 == 1, "s").otherwise("fs").alias("kind"), F.when(k % 4 > 0, shade(9)).alias("fill"), shade(1).alias("stroke"), (k % 100).alias("items"), (k % 6 == 0).alias("route_like"),
    )
    d = labels.snap_to_markers(spots.where("id % 5 = 0").withColumnRenamed("id", "label"), markers)
    return d.select("label", "marker_found", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("marker_box.x1", 4).alias("x1"), "snap_distance", "score", "cluster", "reason")


_MARKERS = """, l AS (SELECT id, page % 2 AS page, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y, (id % 20 + 1) / 2.0::double AS half FROM frames),
    p AS (SELECT a.id AS label, b.id AS marker, b.x, b.y, b.half, sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS d,
        CASE WHEN b.id % 4 > 0 THEN (((b.id * 9) % 10) / 10.0::double + ((b.id * 3) % 10) / 10.0::double + ((b.id * 7) % 10) / 10.0::double) / 3 ELSE 1.0::double END AS fb, ((b.id % 10) / 10.0::double + ((b.id * 3) % 10) / 10.0::double + ((b.id * 7) % 10) / 10.0::double) / 3 AS sb,
        CASE WHEN b.id % 4 > 0 THEN ((b.id * 9) % 10) / 10.0::double - (((b.id * 3) % 10) / 10.0::double + ((b.id * 7) % 10) / 10.0::double) / 2 ELSE 0.0::double END AS fr, (b.id % 10) / 10.0::double - (((b.id * 3) % 10) / 10.0::double + ((b.id * 7) % 10) / 10.0::double) / 2 AS sr
        FROM l a JOIN l b ON a.page = b.page AND a.id % 5 = 0 AND b.id % 5 > 0 AND sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) <= 42),
    s AS (SELECT *, greatest(0.0::double, 40.0::double - d) / 10 + CASE WHEN marker % 3 = 1 THEN 0.2::double ELSE 1.1::double END + CASE WHEN 2 * half <= 12 AND 2 * half >= 1.5 THEN 1.0::double WHEN 2 * half <= 18 THEN 0.4::double ELSE 0 END + CASE WHEN least(fb, sb) < 0.45::double THEN 1.1::double ELSE 0 END
        + CASE WHEN fr > 0.25::double OR sr > 0.25::double THEN 0.5::double ELSE 0 END + CASE WHEN marker % 100 BETWEEN 2 AND 80 THEN 0.3::double ELSE 0 END - CASE WHEN marker % 6 = 0 THEN 2.2::double ELSE 0 END AS score FROM p),
    b AS (SELECT label, score AS best, x AS bx, y AS by_ FROM s QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, marker) = 1),
    c AS (SELECT label, avg(x) AS cx, avg(y) AS cy, max(x + half) AS x1, count(*) AS n FROM s JOIN b USING (label) WHERE best >= 1.25::double AND sqrt(pow(x - bx, 2) + pow(y - by_, 2)) <= 8 AND score >= best - 1.25::double GROUP BY 1)
    SELECT id AS label, n IS NOT NULL AS marker_found, round(coalesce(cx, x), 4) AS x, round(coalesce(cy, y), 4) AS y, round(x1, 4) AS x1, round(sqrt(pow(coalesce(cx, x) - x, 2) + pow(coalesce(cy, y) - y, 2)), 3) AS snap_distance, round(coalesce(best, 0), 3) AS score,
      coalesce(n, 0) AS cluster, CASE WHEN best IS NULL THEN 'marker_not_found' WHEN n IS NULL THEN 'marker_score_low' ELSE 'marker_snapped' END AS reason FROM l LEFT JOIN b ON b.label = id LEFT JOIN c ON c.label = id WHERE id % 5 = 0"""


def label_roles(spark, sf_dir):
    d = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    label = F.when(k % 5 == 0, F.concat(F.lit("四国霊場第"), (k % 88 + 1).cast("string"), F.lit("番"))).when(k % 5 == 1, F.lit("四国別格霊場第３番奥の院")).when(k % 5 == 2, F.lit("さんかくじ")).when(k % 5 == 3, F.lit(" 三角寺 ")).otherwise(F.col("p_name"))
    role = text.label_role(label, (k % 4).cast("int"), [1, 2], [0])
    return d.select(k.alias("label_id"), role.alias("role"), F.coalesce(text.number_in(label), F.lit(0)).alias("number"), text.last_part(F.col("p_name")).alias("tail"))


def normalize_text(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", F.md5(text.normalized(F.concat(F.lit("圓龍ヶ （１２）"), F.col("text")))).alias("digest"))


def fuzzy_gazetteer(spark, sf_dir):
    """Each part name with the region of which a name, its own or one of its nations', is most alike, exact first."""
    nations = table(spark, sf_dir, "nation").select("n_regionkey", F.lower("n_name").alias("nation"))
    g = table(spark, sf_dir, "region").join(nations, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    g = F.broadcast(g.select("r_regionkey", F.explode(F.array(F.lower("r_name"), "nation")).alias("name")).where("name is not null").distinct())
    p = table(spark, sf_dir, "part").select(F.lower("p_name").alias("label")).distinct()
    d = p.join(g, F.lit(True), "left").withColumn("ratio", text.sequence_ratio("label", "name"))
    return joins.best_per(d, ["label"], F.desc_nulls_last("ratio"), F.col("r_regionkey")).select("label", "r_regionkey", F.round("ratio", 6).alias("ratio"))


def mask_dilate(spark, sf_dir):
    d = frames(spark, sf_dir).select((F.col("x0") % 160).cast("int").alias("x"), (F.col("y0") % 160).cast("int").alias("y")).distinct()
    reach = F.array(*[F.lit(k) for k in (-2, -1, 0, 1, 2)])
    return d.withColumn("dx", F.explode(reach)).withColumn("dy", F.explode(reach)).select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y")).distinct()


def mask_metrics(spark, sf_dir):
    f = frames(spark, sf_dir)
    a = f.where("id % 3 < 2").select("page", (F.col("x0") % 40).alias("x"), (F.col("y0") % 40).alias("y")).distinct().withColumn("red", F.lit(1))
    b = f.where("id % 3 > 0").select("page", (F.col("x0") % 40).alias("x"), (F.col("y0") % 40).alias("y")).distinct().withColumn("route", F.lit(1))
    s = a.join(b, ["page", "x", "y"], "full").groupBy("page").agg(F.count("red").alias("red"), F.count("route").alias("route"), F.count_if(F.col("red").isNotNull() & F.col("route").isNotNull()).alias("shared"))
    ratio = lambda x: F.round(F.coalesce(F.try_divide(F.col("shared"), x), F.lit(0.0)), 6)
    return s.select("page", "red", "route", "shared", ratio(F.col("route")).alias("precision"), ratio(F.col("red")).alias("recall"), ratio(F.col("red") + F.col("route") - F.col("shared")).alias("iou"))


_MASKS = """, a AS (SELECT DISTINCT page, x0 % 40 AS x, y0 % 40 AS y FROM frames WHERE id % 3 < 2), b AS (SELECT DISTINCT page, x0 % 40 AS x, y0 % 40 AS y FROM frames WHERE id % 3 > 0),
    s AS (SELECT coalesce(a.page, b.page) AS page, count(a.x) AS red, count(b.x) AS route, count(*) FILTER (a.x IS NOT NULL AND b.x IS NOT NULL) AS shared FROM a FULL JOIN b ON a.page = b.page AND a.x = b.x AND a.y = b.y GROUP BY 1)
    SELECT *, round(coalesce(shared::double / nullif(route, 0), 0), 6) AS precision, round(coalesce(shared::double / nullif(red, 0), 0), 6) AS recall, round(coalesce(shared::double / nullif(red + route - shared, 0), 0), 6) AS iou FROM s"""


def problem_and_action(spark, sf_dir):
    c = F.col
    d = drawings(spark, sf_dir).groupBy("draw", "line").agg(F.min("part").alias("part"))
    k = c("draw") + c("line") * 7 + c("part")
    r = lambda m, n=100.0: ((k * m) % 101) / n
    issues = F.array(*[F.lit(x) for x in ("likely_georef_misalignment", "mixed_alignment_or_missing_path", "possible_missing_trail_in_osm", "needs_manual_review")])
    d = d.select("draw", "line", (k % 5 == 0).alias("ok"), (k % 6 == 0).cast("int").alias("branches"), (k % 4).alias("chains"), F.when(k % 2 == 0, "walk_sub").otherwise("walk_main").alias("style"), r(3).alias("precision"), r(5).alias("recall"), r(7, 400.0).alias("iou"),
                 F.get(issues, (k % 4).cast("int")).alias("issue"), r(11, 500.0).alias("failed"), r(13).alias("snapped"), (k % 9 == 0).alias("edge"), (k % 10 == 0).alias("small"), r(17, 1.0).alias("p90"), r(19, 1.0).alias("longest"), (k % 3 > 0).alias("control"))
    p = rules.problem_type(c("ok"), c("branches"), c("chains"), c("style"), c("precision"), c("recall"), c("iou"), c("issue"), c("failed"), c("snapped"), c("edge"), c("small"))
    d = d.withColumn("problem", p)
    act = rules.recommended_action(c("ok"), c("problem"), c("iou"), c("issue"), c("p90"), c("longest"), c("failed"), c("snapped"), c("control"))
    return d.groupBy("problem", act.alias("action")).agg(F.count("*").alias("routes"))


_PROBLEM = """, g AS (SELECT draw, line, draw + line * 7 + min(part) AS k FROM drawings GROUP BY draw, line),
    v AS (SELECT k % 5 = 0 AS ok, k % 6 = 0 AS branched, k % 4 AS chains, k % 2 = 0 AS side, ((k*3)%101)/100.0::double AS prec, ((k*5)%101)/100.0::double AS rec, ((k*7)%101)/400.0::double AS iou, ['likely_georef_misalignment','mixed_alignment_or_missing_path','possible_missing_trail_in_osm','needs_manual_review'][k % 4 + 1] AS issue,
      ((k*11)%101)/500.0::double AS failed, ((k*13)%101)/100.0::double AS snapped, k % 9 = 0 AS edge, k % 10 = 0 AS small, ((k*17)%101)::double AS p90, ((k*19)%101)::double AS longest, k % 3 > 0 AS control FROM g),
    p AS (SELECT *, CASE WHEN ok THEN 'correct_extraction_but_georef_or_osm_issue' WHEN branched THEN 'wrong_merge' WHEN chains > 1 THEN 'broken_chain' WHEN side AND edge THEN 'frame_assignment_error' WHEN side AND prec < 0.16 AND rec < 0.08 THEN 'legend_or_label_noise'
      WHEN prec < 0.18 AND rec >= 0.18 THEN 'extra_segment' WHEN rec < 0.15 AND prec >= 0.22 THEN 'missing_segment' WHEN issue = 'mixed_alignment_or_missing_path' AND snapped < 0.65 THEN 'correct_extraction_but_georef_or_osm_issue'
      WHEN issue = 'likely_georef_misalignment' AND failed > 0.05 THEN 'correct_extraction_but_georef_or_osm_issue' WHEN side AND small THEN 'wrong_style_class' WHEN iou < 0.08 THEN 'wrong_merge' ELSE 'correct_extraction_but_georef_or_osm_issue' END AS problem FROM v)
    SELECT problem, CASE WHEN NOT ok AND problem = 'correct_extraction_but_georef_or_osm_issue' AND iou >= 0.16 THEN CASE WHEN issue = 'mixed_alignment_or_missing_path' THEN 'osm_missing_or_trail' WHEN issue = 'likely_georef_misalignment' THEN 'manual_edit_needed' WHEN p90 < 60 AND snapped >= 0.7 THEN 'map_match_candidate' ELSE 'manual_edit_needed' END
      WHEN NOT ok AND problem IN ('extra_segment','frame_assignment_error','legend_or_label_noise') THEN 'manual_edit_needed' WHEN NOT ok THEN 'extraction_fix_needed' WHEN NOT control AND longest > 80 THEN 'georef_gcp_recheck' WHEN longest < 50 AND failed < 0.05 THEN 'accept_as_is'
      WHEN issue = 'possible_missing_trail_in_osm' THEN 'osm_missing_or_trail' WHEN issue = 'mixed_alignment_or_missing_path' AND snapped < 0.6 THEN 'osm_missing_or_trail' WHEN p90 < 60 AND snapped >= 0.7 THEN 'map_match_candidate' ELSE 'manual_edit_needed' END AS action, count(*) AS routes FROM p GROUP BY 1, 2"""


def panel_status(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 300).alias("panel")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("done"), F.count_if(F.col("o_orderstatus") == "P").alias("reviewed"))
    panels = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 310).alias("panel")).distinct()
    d = panels.join(o, "panel", "left").fillna(0)
    return d.select("panel", rules.panel_status(F.col("n"), F.col("done"), F.col("reviewed")).alias("status"))


def reason_join(spark, sf_dir):
    k = F.col("draw") + F.col("line")
    d = drawings(spark, sf_dir).select("draw", "line").distinct()
    first = F.when(k % 3 == 0, "missing_frame_id|frame_model_missing").when(k % 3 == 1, "route_not_transformed")
    d = d.select("draw", "line", text.add_reason(first, "route_not_transformed", "|").alias("reasons"))
    return d.withColumn("sorted_reasons", F.array_join(F.sort_array(F.split("reasons", "[|]")), ","))


QUERIES = {f.__name__: f for f in (
    classify_objects, page_histogram, top_pages, frame_score, rect_pairs_iou, assign_frame, overlap_assign, frame_numbering, parent_suppress, redundant_suppress, legend_suppress, rect_components,
    greedy_dedupe, frame_merge, greedy_cover, snap_nodes, build_chains, branch_nodes, segment_confidence, component_confidence, parallel_duplicates, name_group_top1, marker_cluster, label_roles,
    normalize_text, fuzzy_gazetteer, mask_dilate, mask_metrics, problem_and_action, panel_status, reason_join,
)}

_D, _F = "drawings", "frames"
ORACLES = {
    "classify_objects": with_(_D, CLASSIFIED + " SELECT class, count(*) AS objects, round(sum(round(path, 2)), 1) AS total_length FROM classified GROUP BY 1"),
    "page_histogram": with_(_D, CLASSIFIED + " SELECT p.page, coalesce(class, 'none') AS class, count(class) AS objects FROM (SELECT DISTINCT o_orderkey % 70 AS page FROM orders) p LEFT JOIN classified c ON p.page = c.page GROUP BY 1, 2"),
    "top_pages": with_(_D, CLASSIFIED + " SELECT page, round(sum(round(path, 2)), 1) AS total_length, count(*) AS objects FROM classified GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 25"),
    "frame_score": with_("drawings frames", CLASSIFIED + _FRAME_SCORE),
    "rect_pairs_iou": with_(_F, f" SELECT a.id AS a, b.id AS b, round({_BOTH} / ({_AREA.format('a')} + {_AREA.format('b')} - {_BOTH}), 6) AS iou, round({_BOTH} / {_AREA.format('a')}, 6) AS overlap FROM frames a JOIN frames b ON a.page = b.page AND a.id < b.id AND {_GAP_SQL} <= 0"),
    "assign_frame": with_("drawings frames", """, items AS (SELECT draw * 10 + line AS item_id, min(page) % 32 AS page, min(px) AS x, min(py) AS y FROM drawings GROUP BY draw, line),
        j AS (SELECT item_id, id, id % 97 AS score, (x1-x0)*(y1-y0) AS area, x + 3 BETWEEN x0 AND x1 AND y + 2 BETWEEN y0 AND y1 AS held, sqrt(pow(greatest(0, x0 - x - 6, x - x1), 2) + pow(greatest(0, y0 - y - 4, y - y1), 2)) AS gap
            FROM items i JOIN frames f ON i.page = f.page AND x0 - x - 6 <= 24 AND x - x1 <= 24 AND y0 - y - 4 <= 24 AND y - y1 <= 24),
        m AS (SELECT item_id, id, CASE WHEN held THEN 0.0::double ELSE gap END AS gap FROM j WHERE held OR gap <= 24 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY NOT held, CASE WHEN NOT held THEN gap END, area, CASE WHEN held THEN -score END, id) = 1)
        SELECT item_id, coalesce(id, -1) AS frame_id, round(gap, 6) AS gap FROM items LEFT JOIN m USING (item_id)"""),
    "overlap_assign": with_(_F, f", m AS (SELECT a.id AS label, b.id AS frame_id, {_BOTH} / {_AREA.format('a')} AS share FROM frames a JOIN frames b ON a.page = b.page AND a.size <= 12 AND b.size > 12) SELECT label, frame_id, round(share, 6) AS share FROM m WHERE share >= 0.25 QUALIFY row_number() OVER (PARTITION BY label ORDER BY m.share DESC, frame_id) = 1"),
    "frame_numbering": with_(_F, " SELECT id, printf('%03d_f%02d', page, row_number() OVER (PARTITION BY page ORDER BY y0, x0, (x1-x0)*(y1-y0) DESC, id)) AS frame_name FROM frames"),
    "parent_suppress": with_(_F, _SUPPORT + f""", st AS (SELECT a.id AS parent, a.n AS pn, b.id AS child FROM sup a JOIN sup b ON a.page = b.page AND a.id <> b.id AND b.area < a.area * 0.92::double AND {_INSIDE.format(6)} WHERE a.n >= 6 AND b.n >= 3 AND b.n >= floor(a.n * 0.22::double))
        SELECT parent AS suppressed FROM st JOIN held h ON h.id = child GROUP BY parent, pn HAVING count(DISTINCT child) >= 2 AND count(DISTINCT o) >= floor(pn * 0.78::double)"""),
    "redundant_suppress": with_(_F, _SUPPORT + """, sh AS (SELECT a.id AS parent, a.n AS pn, b.id AS child, h.o FROM sup a JOIN sup b ON a.page = b.page AND a.n >= 6 AND b.area < a.area * 0.88::double JOIN held h ON h.id = a.id JOIN held k ON k.id = b.id AND k.o = h.o),
        en AS (SELECT parent, child FROM sh GROUP BY parent, child, pn HAVING count(DISTINCT o) >= greatest(3, floor(pn * 0.18::double)))
        SELECT parent AS suppressed FROM sh JOIN en USING (parent, child) GROUP BY parent, pn HAVING count(DISTINCT child) >= 2 AND count(DISTINCT o) >= floor(pn * 0.68::double)"""),
    "legend_suppress": with_(_F, _SUPPORT + f""" SELECT DISTINCT b.id AS suppressed FROM sup a JOIN sup b ON a.page = b.page AND a.id <> b.id AND a.area > b.area * 1.4::double AND {_INSIDE.format(8)}
        WHERE a.id % 3 < 2 AND b.id % 2 = 0 AND a.n >= greatest(6, floor(b.n * 1.3::double)) AND NOT EXISTS (SELECT 1 FROM held x WHERE x.id = b.id AND x.o NOT IN (SELECT o FROM held y WHERE y.id = a.id))"""),
    "rect_components": with_(_F, f""", e AS (SELECT a.id AS a, b.id AS b FROM frames a JOIN frames b ON a.page = b.page AND a.id <> b.id AND {_GAP_SQL} <= {GAP}),
        r AS (SELECT id AS node, id AS reach FROM frames UNION SELECT r.node, e.b FROM r JOIN e ON r.reach = e.a), c AS (SELECT node, min(reach) AS component FROM r GROUP BY 1)
        SELECT component, count(*) AS members, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM c JOIN frames ON id = node GROUP BY 1""", recursive=True),
    "branch_nodes": "SELECT page, node, count(*) AS degree FROM (SELECT p_partkey % 16 AS page, unnest([(p_partkey * 7919) % 97, (p_partkey * 104729) % 89]) AS node FROM part) GROUP BY 1, 2 HAVING count(*) > 2",
    "segment_confidence": with_(_D, CLASSIFIED + _SEGCONF + " SELECT round(confidence, 4) AS confidence, concat_ws(',', CASE WHEN short THEN 'very_short_segment' END, CASE WHEN unframed THEN 'missing_frame_id' END) AS reasons, count(*) AS segments FROM cf GROUP BY 1, 2"),
    "component_confidence": with_(_D, CLASSIFIED + _SEGCONF + """, g AS (SELECT draw % 500 AS component, avg(confidence) AS mean, bool_or(short OR unframed) AS low, count(*) AS n, count(*) FILTER (class = 'red_solid_route') AS routes FROM cf GROUP BY 1)
        SELECT component, round(least(greatest(mean - CASE WHEN n % 3 > 0 THEN 0.10::double ELSE 0 END - CASE WHEN n % 4 > 1 THEN 0.07::double ELSE 0 END - CASE WHEN component % 5 = 0 THEN 0.08::double ELSE 0 END - CASE WHEN low THEN 0.06::double ELSE 0 END - CASE WHEN component % 7 = 0 THEN 0.12::double ELSE 0 END - CASE WHEN component % 11 = 0 THEN 0.10::double ELSE 0 END, 0), 0.98::double), 4) AS confidence,
        concat_ws('|', CASE WHEN n % 3 > 0 THEN 'branching_component' END, CASE WHEN n % 4 > 1 THEN 'multi_chain_component' END, CASE WHEN component % 5 = 0 THEN 'fallback_frame' END, CASE WHEN low THEN 'contains_low_confidence_segment' END, CASE WHEN component % 7 = 0 THEN 'frame_assignment_error' END, CASE WHEN component % 11 = 0 THEN 'extra_segment' END) AS reasons,
        CASE WHEN routes * 2 >= n THEN 'walk_main' ELSE 'unknown_red' END AS style FROM g"""),
    "parallel_duplicates": with_(_F, """, g AS (SELECT id, page % 4 AS page, x0, y0, x0 + 20 + 6 * size AS x1, y0 + id % 26 AS y1 FROM frames WHERE id % 5 > 0 AND 200 + 5 * size >= 250 AND id % 26 <= 20)
        SELECT a.id AS a, b.id AS b FROM g a JOIN g b ON a.page = b.page AND a.id < b.id AND greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) >= least(a.x1 - a.x0, b.x1 - b.x0) * 0.7::double AND abs((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2) <= 4"""),
    "name_group_top1": with_(_F, _NAMES),
    "marker_cluster": with_(_F, _MARKERS),
    "label_roles": """SELECT p_partkey AS label_id, CASE p_partkey % 5 WHEN 0 THEN 'temple_number' WHEN 1 THEN 'bekkaku_number' ELSE CASE WHEN p_partkey % 4 IN (1, 2) AND p_partkey % 5 = 2 THEN 'temple_reading' WHEN p_partkey % 4 IN (1, 2) AND p_partkey % 5 = 3 THEN 'temple_name' WHEN p_partkey % 4 <> 0 THEN 'colored_label' ELSE 'other' END END AS role,
        CASE WHEN p_partkey % 5 = 0 THEN (p_partkey % 88 + 1)::int ELSE 0 END AS number, string_split(p_name, ' ')[-1] AS tail FROM part""",
    "mask_dilate": with_(_F, " SELECT DISTINCT (x0 % 160)::int + dx::int AS x, (y0 % 160)::int + dy::int AS y FROM frames, range(-2, 3) a(dx), range(-2, 3) b(dy)"),
    "mask_metrics": with_(_F, _MASKS),
    "problem_and_action": with_(_D, _PROBLEM),
    "panel_status": """WITH o AS (SELECT o_custkey % 300 AS panel, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS reviewed FROM orders GROUP BY 1)
        SELECT p.panel, CASE WHEN n IS NULL THEN 'empty' WHEN n = done THEN 'done' WHEN reviewed > 0 THEN 'reviewed' ELSE 'draft' END AS status FROM (SELECT DISTINCT c_custkey % 310 AS panel FROM customer) p LEFT JOIN o USING (panel)""",
    "reason_join": """SELECT DISTINCT l_orderkey AS draw, l_linenumber AS line, CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'missing_frame_id|frame_model_missing|route_not_transformed' ELSE 'route_not_transformed' END AS reasons,
        CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'frame_model_missing,missing_frame_id,route_not_transformed' ELSE 'route_not_transformed' END AS sorted_reasons FROM lineitem""",
}
