"""Tables, and shapes derived from them by whole-number arithmetic, in both engines.

The tables have no geography, so points, rectangles and control points come from
keys.  ``CTE`` holds the same definitions in the SQL of the second engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.functions.rect import rect


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of points, one a user, in order of (ts, event_id)."""
    lon = 132.5 + 2.5 * ((F.col("event_id") * 7919) % 10007) / F.lit(10007.0)
    lat = 32.8 + 1.7 * ((F.col("event_id") * 104729) % 10009) / F.lit(10009.0)
    return table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value", "event_type", lon.alias("lon"), lat.alias("lat"))


def drawings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drawings on pages, one a line item; their key is all of their columns."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        (c("l_suppkey") % 64).alias("page"),
        c("l_orderkey").alias("draw"), c("l_linenumber").alias("line"), c("l_partkey").alias("part"),
        (c("l_quantity") * 4).alias("box_w"),
        (c("l_discount") * 1000 + 2.0).alias("box_h"),
        (c("l_quantity") * 6 + c("l_tax") * 500).alias("path"),
        (0.5 + c("l_tax") * 25).alias("width"),
        F.when(c("l_returnflag") == "R", "fs").otherwise("s").alias("draw_type"),
        F.when(c("l_returnflag") == "R", c("l_discount") + 0.0).alias("fill_distance"),
        F.when(c("l_linestatus") == "O", "dashed").otherwise("solid").alias("dash"),
        (c("l_linenumber") % 2).alias("closed"), c("l_linenumber").alias("segments"),
        ((c("l_orderkey") * 7919 + c("l_linenumber")) % 1100).cast("double").alias("px"),
        ((c("l_orderkey") * 104729 + c("l_partkey")) % 780).cast("double").alias("py"),
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles on pages, one a part."""
    c = F.col
    p = table(spark, sf_dir, "part").select(
        c("p_partkey").alias("id"), (c("p_partkey") % 32).alias("page"), c("p_size").alias("size"),
        ((c("p_partkey") * 7919) % 997).cast("double").alias("x0"), ((c("p_partkey") * 104729) % 701).cast("double").alias("y0"),
    )
    p = p.withColumn("x1", c("x0") + 10 + c("size")).withColumn("y1", c("y0") + 8 + c("size"))
    return p.withColumn("box", rect(c("x0"), c("y0"), c("x1"), c("y1")))


def control_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control points by nation (page) and key (frame): a known similarity with whole-number noise."""
    c, k = F.col, F.col("c_custkey")
    x, y = ((k * 7919) % 595).cast("double"), ((k * 104729) % 842).cast("double")
    noise = lambda a, m: (((k * a) % m) - m // 2).cast("double")
    return table(spark, sf_dir, "customer").select(
        k.alias("gcp"), c("c_nationkey").cast("long").alias("page_no"), (k % 5).cast("string").alias("frame_id"), x.alias("x"), y.alias("y"),
        (133.0 + (x * 12.0 + (842.0 - y) * 3.0 + noise(31, 61)) / 91000.0).alias("lon"),
        (33.5 + ((842.0 - y) * 12.0 - x * 3.0 + noise(37, 67)) / 111000.0).alias("lat"),
        (0.5 + (k % 50) / F.lit(100.0)).alias("confidence"),
        F.when(k % 7 == 0, "manual").otherwise("auto").alias("source"), F.lit(842.0).alias("page_height"),
    )


CTE = {
    "points": """points AS (SELECT user_id, ts, event_id, value, event_type,
        132.5::double + 2.5::double * ((event_id * 7919) % 10007) / 10007.0::double AS lon,
        32.8::double + 1.7::double * ((event_id * 104729) % 10009) / 10009.0::double AS lat FROM events)""",
    "drawings": """drawings AS (SELECT l_suppkey % 64 AS page, l_orderkey AS draw, l_linenumber AS line, l_partkey AS part,
        l_quantity * 4 AS box_w, l_discount * 1000 + 2.0::double AS box_h, l_quantity * 6 + l_tax * 500 AS path,
        0.5::double + l_tax * 25 AS width, CASE WHEN l_returnflag = 'R' THEN 'fs' ELSE 's' END AS draw_type,
        CASE WHEN l_returnflag = 'R' THEN l_discount + 0.0::double END AS fill_distance,
        CASE WHEN l_linestatus = 'O' THEN 'dashed' ELSE 'solid' END AS dash, l_linenumber % 2 AS closed, l_linenumber AS segments,
        ((l_orderkey * 7919 + l_linenumber) % 1100)::double AS px, ((l_orderkey * 104729 + l_partkey) % 780)::double AS py FROM lineitem)""",
    "frames": """frames AS (SELECT *, x0 + 10 + size AS x1, y0 + 8 + size AS y1 FROM (SELECT p_partkey AS id, p_partkey % 32 AS page,
        p_size AS size, ((p_partkey * 7919) % 997)::double AS x0, ((p_partkey * 104729) % 701)::double AS y0 FROM part))""",
    "gcps": """gcps AS (SELECT gcp, page_no, frame_id, x, y, confidence, source, 842.0::double AS page_height,
        133.0::double + (x * 12.0::double + (842.0::double - y) * 3.0::double + (((gcp * 31) % 61) - 30)::double) / 91000.0::double AS lon,
        33.5::double + ((842.0::double - y) * 12.0::double - x * 3.0::double + (((gcp * 37) % 67) - 33)::double) / 111000.0::double AS lat
        FROM (SELECT c_custkey AS gcp, c_nationkey::bigint AS page_no, (c_custkey % 5)::varchar AS frame_id, ((c_custkey * 7919) % 595)::double AS x,
        ((c_custkey * 104729) % 842)::double AS y, 0.5::double + (c_custkey % 50) / 100.0::double AS confidence,
        CASE WHEN c_custkey % 7 = 0 THEN 'manual' ELSE 'auto' END AS source FROM customer))""",
}

HAVERSINE = """2 * 6378137.0::double * atan2(sqrt({a}), sqrt(greatest(1 - ({a}), 0.0::double)))"""


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    a = f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    return HAVERSINE.format(a=a)


def with_(names: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(CTE[n] for n in names.split()) + body
