"""Queries over lines of points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeloom.functions import color, geo, line
from routeloom.operators import joins, rules, windows
from routeloom.plans.base import haversine_sql, points, table, with_

KEY, ORDER = ["user_id"], ["ts", "event_id"]


def _measured(spark, sf_dir) -> DataFrame:
    far = lambda before, here: geo.haversine_m(before("lon"), before("lat"), here("lon"), here("lat"))
    return windows.with_steps(points(spark, sf_dir), KEY, ORDER, far)


_STEP = f"coalesce({haversine_sql('lag(lon) OVER w', 'lag(lat) OVER w', 'lon', 'lat')}, 0.0::double)"
MEASURED = f""", stepped AS (SELECT *, {_STEP} AS step, row_number() OVER w AS idx FROM points WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    measured AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS along FROM stepped)"""


def trajectory_length(spark, sf_dir):
    d = _measured(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("vertices"), F.sum("step").alias("m"))
    return d.select("user_id", "vertices", F.round("m", 2).alias("length_m"))


def trajectory_bbox_plausible(spark, sf_dir):
    box = points(spark, sf_dir).groupBy("user_id").agg(*[f(c).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("min", F.min), ("max", F.max))])
    ok = geo.plausible(F.col("min_lon"), F.col("max_lon"), F.col("min_lat"), F.col("max_lat"), spans=(2.45, 1.66))
    return box.select("user_id", *[F.round(c, 6).alias(c) for c in box.columns[1:]], ok.alias("plausible"))


def trajectory_cumulative(spark, sf_dir):
    return _measured(spark, sf_dir).select("user_id", "event_id", F.round("along", 2).alias("along_m"))


def trajectory_midpoint(spark, sf_dir):
    d = windows.midpoint(_measured(spark, sf_dir), KEY, ORDER, "lon", "lat")
    return d.select("user_id", F.round("mid_x", 6).alias("mid_lon"), F.round("mid_y", 6).alias("mid_lat"))


DENSE_M = 20000.0


def _dense(spark, sf_dir) -> DataFrame:
    """Samples every ``DENSE_M`` along each step, beginning anew at each vertex, and the vertices."""
    d = _measured(spark, sf_dir)
    w = Window.partitionBy(*KEY).orderBy(*ORDER)
    d = d.withColumn("lon0", F.lag("lon").over(w)).withColumn("lat0", F.lag("lat").over(w)).where((F.col("step") > 0) & F.col("lon0").isNotNull())
    count = F.ceil(F.col("step") / DENSE_M).cast("int")  # strictly inside: a whole multiple does not repeat the vertex
    d = d.withColumn("k", F.explode(F.sequence(F.lit(1), count)))
    t = F.when(F.col("k") == count, 1.0).otherwise(F.col("k") * DENSE_M / F.col("step"))
    return d.select("user_id", "event_id", "k", (F.col("lon0") + t * (F.col("lon") - F.col("lon0"))).alias("lon"), (F.col("lat0") + t * (F.col("lat") - F.col("lat0"))).alias("lat"))


def trajectory_densify(spark, sf_dir):
    d = _dense(spark, sf_dir)
    return d.select("user_id", "event_id", "k", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


DENSE = f""", ahead AS (SELECT *, lag(lon) OVER (PARTITION BY user_id ORDER BY idx) AS lon0, lag(lat) OVER (PARTITION BY user_id ORDER BY idx) AS lat0 FROM measured),
    cut AS (SELECT *, unnest(range(1, ceil(step / {DENSE_M}::double)::int + 1))::int AS k, ceil(step / {DENSE_M}::double)::int AS n FROM ahead WHERE step > 0 AND lon0 IS NOT NULL),
    dense AS (SELECT user_id, event_id, k, lon0 + t * (lon - lon0) AS lon, lat0 + t * (lat - lat0) AS lat FROM (SELECT *, CASE WHEN k = n THEN 1.0::double ELSE k * {DENSE_M}::double / step END AS t FROM cut))"""


def mercator_roundtrip(spark, sf_dir):
    x, y = geo.mercator(F.col("lon"), F.col("lat"))
    lon, lat = geo.mercator_inverse(F.col("x"), F.col("y"))
    return points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y")).select("event_id", F.round("x", 3).alias("x_m"), F.round("y", 3).alias("y_m"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def equirect_roundtrip(spark, sf_dir):
    ref = F.lit(133.5), F.lit(33.6)
    x, y = geo.equirect(F.col("lon"), F.col("lat"), *ref)
    lon, lat = geo.equirect_inverse(F.col("x"), F.col("y"), *ref)
    return points(spark, sf_dir).select("event_id", x.alias("x"), y.alias("y")).select("event_id", F.round("x", 3).alias("x_m"), F.round("y", 3).alias("y_m"), F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


def bezier_length(spark, sf_dir):
    at = lambda m, n: line.point(((F.col("event_id") * m) % 97).cast("double"), ((F.col("event_id") * n) % 89).cast("double"))
    curve = line.bezier(at(3, 5), at(7, 11), at(13, 17), at(19, 23))
    return points(spark, sf_dir).select("event_id", F.size(curve).alias("n_points"), F.round(line.length(curve), 4).alias("length"))


def color_distance_filter(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 3), lambda v: F.abs(v.cast("double"))).alias("stroke"), F.transform(F.slice("embedding", 4, 3), lambda v: F.abs(v.cast("double"))).alias("fill"))
    e = e.withColumn("fill", F.when(F.col("vec_id") % 3 > 0, F.col("fill")))
    target = F.array(F.lit(0.1), F.lit(0.1), F.lit(0.1))
    d = lambda c: F.round(color.l1_distance(F.col(c), target), 6)
    return e.where(color.close_to(F.col("stroke"), F.col("fill"), target, 0.2)).select("vec_id", d("stroke").alias("stroke_distance"), d("fill").alias("fill_distance"))


def worst_samples(spark, sf_dir):
    d = points(spark, sf_dir).orderBy(F.desc("value"), "event_id").limit(30)
    return d.select("event_id", "user_id", F.round("value", 3).alias("value"))


def failed_runs(spark, sf_dir):
    d = windows.runs(points(spark, sf_dir), KEY, ORDER, F.col("value") > 50)
    return d.select("user_id", F.col("run_start").cast("long"), F.col("run_end").cast("long"), "run_length")


def nearest_rank_percentile(spark, sf_dir):
    q = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY value)")
    return points(spark, sf_dir).groupBy("user_id").agg(q(0.5).alias("p50"), q(0.9).alias("p90"), q(0.95).alias("p95"))


def best_confidence_dedupe(spark, sf_dir):
    d = points(spark, sf_dir).withColumn("slot", F.col("event_id") % 20)
    return joins.best_per(d, ["user_id", "slot"], F.desc("value"), F.col("event_id")).select("user_id", "slot", "event_id", "value")


def _segments(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    ax, ay = ((k * 7919) % 2500).cast("double"), ((k * 104729) % 1700).cast("double")
    kinds = F.array(*[F.lit(h) for h in ("residential", "path", "motorway", "track", "footway", "primary")])
    return table(spark, sf_dir, "supplier").select(k.alias("segment_id"), ax.alias("ax"), ay.alias("ay"), (ax + (k * 31) % 120 - 60).alias("bx"), (ay + (k * 17) % 90 - 45).alias("by"), F.get(kinds, (k % 6).cast("int")).alias("highway"))


def _near(spark, sf_dir, *columns: str) -> DataFrame:
    p = points(spark, sf_dir)
    places = p.select(F.col("event_id").alias("point_id"), "user_id", ((F.col("event_id") * 7919) % 2503).cast("double").alias("x"), ((F.col("event_id") * 104729) % 1709).cast("double").alias("y"))
    own = [c for c in ("point_id", "user_id") if c in columns]
    return joins.nearest_segment(places.select(*own, "x", "y"), _segments(spark, sf_dir), 150.0, columns)


def nearest_segment(spark, sf_dir):
    return _near(spark, sf_dir, "point_id", "distance").select(F.col("point_id").alias("event_id"), F.round("distance", 6).alias("distance"))


SNAP_REACH = 35.0
# Road classes that a sample may snap to.
SNAP_CLASSES = (
    "motorway_link", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified",
    "residential", "service", "living_street", "pedestrian", "footway", "path", "track", "cycleway", "steps",
)
FOOT_CLASSES = ("footway", "path", "track", "steps", "pedestrian", "cycleway")


def road_summary(spark, sf_dir):
    d = _near(spark, sf_dir, "user_id", "highway", "distance").where("distance is not null")
    snapped = (F.col("distance") <= SNAP_REACH) & F.col("highway").isin(*SNAP_CLASSES)
    far = F.col("distance") > 50
    s = d.groupBy("user_id").agg(
        F.count("*").alias("samples"), F.avg("distance").alias("mean_d"), F.max("distance").alias("max_d"), F.avg(snapped.cast("double")).alias("ratio"),
        F.count_if(far).alias("far"), F.count_if(far & F.col("highway").isin(*FOOT_CLASSES)).alias("foot"),
    )
    issue = rules.likely_issue(F.col("max_d") - 120, F.col("ratio"), F.col("far"), F.col("foot"))
    return s.select("user_id", "samples", F.round("mean_d", 3).alias("mean_distance"), F.round("max_d", 3).alias("max_distance"), F.round("ratio", 4).alias("snap_ratio"), issue.alias("likely_issue"))


_SEG = """, seg AS (SELECT s_suppkey AS segment_id, ((s_suppkey * 7919) % 2500)::double AS ax, ((s_suppkey * 104729) % 1700)::double AS ay,
    ((s_suppkey * 7919) % 2500)::double + (s_suppkey * 31) % 120 - 60 AS bx, ((s_suppkey * 104729) % 1700)::double + (s_suppkey * 17) % 90 - 45 AS by_,
    ['residential','path','motorway','track','footway','primary'][s_suppkey % 6 + 1] AS highway FROM supplier),
  pt AS (SELECT event_id, user_id, ((event_id * 7919) % 2503)::double AS x, ((event_id * 104729) % 1709)::double AS y FROM points),
  prj AS (SELECT event_id, user_id, segment_id, highway, x, y, ax, ay, bx - ax AS dx, by_ - ay AS dy,
    CASE WHEN (bx-ax)*(bx-ax) + (by_-ay)*(by_-ay) <= 1e-12 THEN 0.0::double ELSE greatest(0.0::double, least(1.0::double, ((x-ax)*(bx-ax) + (y-ay)*(by_-ay)) / ((bx-ax)*(bx-ax) + (by_-ay)*(by_-ay)))) END AS t FROM pt, seg),
  dist AS (SELECT *, sqrt((x-ax-t*dx)*(x-ax-t*dx) + (y-ay-t*dy)*(y-ay-t*dy)) AS distance FROM prj),
  near AS (SELECT * FROM dist QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY distance, segment_id) = 1)"""


def adopt_candidate(spark, sf_dir):
    d = points(spark, sf_dir).groupBy("user_id").agg(
        F.avg("value").alias("mean"), F.max("value").alias("top"), F.expr("percentile_disc(0.9) WITHIN GROUP (ORDER BY value)").alias("p90"), F.count("*").alias("n")
    )
    k = F.col("n") % 5
    c = F.col
    adopt, failed = rules.adoption(c("mean") * 0.2, c("p90") * 0.2, c("top") * 0.1, c("mean") * (0.25 + 0.1 * k), c("p90"), c("top"), c("p90") * 0.4, c("top") * 0.1, c("mean") * 0.5, c("top") * 0.1)
    return d.select("user_id", adopt.alias("adopt"), F.array_join(failed, "|").alias("failed_gates"))


def geojson_export(spark, sf_dir):
    d = points(spark, sf_dir).groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("ts", "event_id", F.round("lon", 5).alias("x"), F.round("lat", 5).alias("y")))).alias("p"))
    return d.select("user_id", F.size("p").alias("n_points"), F.array_join(F.transform("p", lambda p: F.format_string("[%.5f,%.5f]", p["x"], p["y"])), ",").alias("coordinates"))


_GATES = """SELECT user_id, g1 AND g2 AND g3 AND g4 AND g5 AND g6 AS adopt, array_to_string(list_filter([
    CASE WHEN NOT g1 THEN 'mean_distance_not_improved_enough' END, CASE WHEN NOT g2 THEN 'p90_distance_not_improved_enough' END, CASE WHEN NOT g3 THEN 'max_distance_not_improved_enough' END,
    CASE WHEN NOT g4 THEN 'displacement_too_large' END, CASE WHEN NOT g5 THEN 'geometry_jump_detected' END, CASE WHEN NOT g6 THEN 'candidate_not_close_enough_to_road' END], lambda x: x IS NOT NULL), '|') AS failed_gates FROM (
    SELECT user_id, mean * 0.2::double <= mean * (0.25::double + 0.1::double * (n % 5)) * 0.7::double AS g1, p90 * 0.2::double <= p90 * 0.7::double AS g2, top * 0.1::double <= greatest(25.0::double, top * 0.6::double) AS g3,
    p90 * 0.4::double <= 30 AND top * 0.1::double <= 40 AS g4, top * 0.1::double <= 35 AND mean * 0.5::double <= 20 AS g5, mean * 0.2::double <= 8 AND p90 * 0.2::double <= 15 AND top * 0.1::double <= 25 AS g6 FROM (
    SELECT user_id, avg(value) AS mean, max(value) AS top, quantile_disc(value, 0.9) AS p90, count(*) AS n FROM points GROUP BY 1))"""

_BEZIER = """ SELECT event_id, 17 AS n_points, round(sum(sqrt((x - px) * (x - px) + (y - py) * (y - py))), 4) AS length FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM (
    SELECT event_id, i, u*u*u * ((event_id*3)%97) + 3*u*u*t * ((event_id*7)%97) + 3*u*t*t * ((event_id*13)%97) + t*t*t * ((event_id*19)%97) AS x,
    u*u*u * ((event_id*5)%89) + 3*u*u*t * ((event_id*11)%89) + 3*u*t*t * ((event_id*17)%89) + t*t*t * ((event_id*23)%89) AS y FROM (
    SELECT event_id, i, i / 16.0::double AS t, 1 - i / 16.0::double AS u FROM points, range(17) r(i))) WINDOW w AS (PARTITION BY event_id ORDER BY i)) GROUP BY 1"""

_R = "6378137.0::double"
QUERIES = {f.__name__: f for f in (
    trajectory_length, trajectory_bbox_plausible, trajectory_cumulative, trajectory_midpoint, trajectory_densify, mercator_roundtrip, equirect_roundtrip, bezier_length,
    color_distance_filter, worst_samples, failed_runs, nearest_rank_percentile, best_confidence_dedupe, nearest_segment, road_summary, adopt_candidate, geojson_export,
)}
ORACLES = {
    "trajectory_length": with_("points", MEASURED + " SELECT user_id, count(*) AS vertices, round(sum(step), 2) AS length_m FROM measured GROUP BY 1"),
    "trajectory_bbox_plausible": with_("points", """ SELECT user_id, round(min(lon), 6) AS min_lon, round(max(lon), 6) AS max_lon, round(min(lat), 6) AS min_lat, round(max(lat), 6) AS max_lat,
        min(lon) >= 131.0 AND max(lon) <= 135.6 AND min(lat) >= 32.0 AND max(lat) <= 35.2 AND max(lon) - min(lon) <= 2.45::double AND max(lat) - min(lat) <= 1.66::double AS plausible FROM points GROUP BY 1"""),
    "trajectory_cumulative": with_("points", MEASURED + " SELECT user_id, event_id, round(along, 2) AS along_m FROM measured"),
    "trajectory_midpoint": with_("points", MEASURED + """, h AS (SELECT *, max(along) OVER (PARTITION BY user_id) / 2 AS half, lag(lon) OVER (PARTITION BY user_id ORDER BY idx) AS x0, lag(lat) OVER (PARTITION BY user_id ORDER BY idx) AS y0 FROM measured)
        SELECT user_id, round(x0 + t * (lon - x0), 6) AS mid_lon, round(y0 + t * (lat - y0), 6) AS mid_lat FROM (SELECT *, CASE WHEN step = 0 THEN 0.0::double ELSE (half - (along - step)) / step END AS t FROM h WHERE along >= half AND x0 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY idx) = 1)"""),
    "trajectory_densify": with_("points", MEASURED + DENSE + " SELECT user_id, event_id, k, round(lon, 6) AS lon, round(lat, 6) AS lat FROM dense"),
    "mercator_roundtrip": with_("points", f""" SELECT event_id, round(x, 3) AS x_m, round(y, 3) AS y_m, round(degrees(x / {_R}), 7) AS lon, round(degrees(2 * atan(exp(y / {_R})) - 1.5707963267948966::double), 7) AS lat
        FROM (SELECT event_id, {_R} * radians(lon) AS x, {_R} * ln(tan(0.7853981633974483::double + radians(greatest(-85.05112878::double, least(85.05112878::double, lat))) / 2)) AS y FROM points)"""),
    "equirect_roundtrip": with_("points", f""" SELECT event_id, round(x, 3) AS x_m, round(y, 3) AS y_m, round(133.5::double + degrees(x / ({_R} * cos(radians(33.6::double)))), 7) AS lon, round(33.6::double + degrees(y / {_R}), 7) AS lat
        FROM (SELECT event_id, radians(lon - 133.5::double) * {_R} * cos(radians(33.6::double)) AS x, radians(lat - 33.6::double) * {_R} AS y FROM points)"""),
    "bezier_length": with_("points", _BEZIER),
    "color_distance_filter": """SELECT vec_id, round(s, 6) AS stroke_distance, round(f, 6) AS fill_distance FROM (SELECT vec_id,
        list_sum([abs(abs(embedding[i]::double) - 0.1::double) for i in [1,2,3]]) AS s, CASE WHEN vec_id % 3 > 0 THEN list_sum([abs(abs(embedding[i]::double) - 0.1::double) for i in [4,5,6]]) END AS f FROM embeddings)
        WHERE coalesce(s <= 0.2::double, false) OR coalesce(f <= 0.2::double, false)""",
    "worst_samples": "SELECT event_id, user_id, round(value, 3) AS value FROM events ORDER BY events.value DESC, event_id LIMIT 30",
    "failed_runs": with_("points", """, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS a FROM points), f AS (SELECT *, a - row_number() OVER (PARTITION BY user_id ORDER BY a) AS g FROM n WHERE value > 50)
        SELECT user_id, min(a) AS run_start, max(a) AS run_end, count(*) AS run_length FROM f GROUP BY user_id, g HAVING count(*) >= 2"""),
    "nearest_rank_percentile": "SELECT user_id, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.9) AS p90, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1",
    "best_confidence_dedupe": "SELECT user_id, event_id % 20 AS slot, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 20 ORDER BY value DESC, event_id) = 1",
    "nearest_segment": with_("points", _SEG + " SELECT event_id, round(distance, 6) AS distance FROM near"),
    "road_summary": with_("points", _SEG + """, r AS (SELECT user_id, count(*) AS samples, avg(distance) AS mean_d, max(distance) AS max_d, avg((distance <= 35 AND highway <> 'motorway')::int::double) AS ratio,
        count(*) FILTER (distance > 50) AS far, count(*) FILTER (distance > 50 AND highway IN ('path','track','footway')) AS foot FROM near GROUP BY 1)
        SELECT user_id, samples, round(mean_d, 3) AS mean_distance, round(max_d, 3) AS max_distance, round(ratio, 4) AS snap_ratio, CASE WHEN max_d - 120 > 100 THEN 'likely_georef_misalignment'
        WHEN far > 0 AND foot >= greatest(1, far // 2) THEN 'possible_missing_trail_in_osm' WHEN ratio < 0.6 THEN 'mixed_alignment_or_missing_path' ELSE 'needs_manual_review' END AS likely_issue FROM r"""),
    "adopt_candidate": with_("points", " " + _GATES),
    "geojson_export": with_("points", " SELECT user_id, count(*)::int AS n_points, string_agg(printf('[%.5f,%.5f]', round(lon, 5), round(lat, 5)), ',' ORDER BY ts, event_id) AS coordinates FROM points GROUP BY 1"),
}
