"""Connected components of a link table, without the driver or one task seeing them all.

Alternating large-star and small-star rounds: each node's neighbours are tied to
the least of them, until every component is one star around its least node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.session import dropped, tables_written, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One half round over (u, v): for each u its neighbours get tied to the least of them and u."""
    both = edges.union(edges.select("v", "u")) if large else edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u").where(F.col("v") > F.col("u") if large else F.lit(True)).select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not large:
        tied = tied.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return tied.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()


def _settled(edges: DataFrame) -> bool:
    """True if each node has one link to a lesser node, or none and only links from greater ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v: long); component is the least node.

    Links of a node with itself and repeated links do no harm; nodes without a
    link to another do not come back.  An empty table gives no rows.
    """
    known = links.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    before = tables_written()
    edges = written(known.distinct(), "links")
    for _ in range(rounds):
        if _settled(edges):
            break
        edges = written(_star(_star(edges, large=True), large=False), "stars")
        dropped(edges.sparkSession, before, keep=1)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
