"""Window operators: running lengths, runs of far samples, midpoints, leave-one-out fits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_steps(df: DataFrame, keys: Sequence[str], order: Sequence[str], distance) -> DataFrame:
    """``step`` from the row before (0 for the first) and ``along``, its running sum.

    ``distance(before, here)`` gets two functions from column name to column.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    step = distance(lambda c: F.lag(c).over(w), F.col)
    return df.withColumn("step", F.coalesce(step, F.lit(0.0))).withColumn("along", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def runs(df: DataFrame, keys: Sequence[str], order: Sequence[str], test: Column, least: int = 2) -> DataFrame:
    """(keys, run_start, run_end, run_length): islands of at least ``least`` rows in a row that pass ``test``.

    A run ends with its key; ``order`` must be total within a key, its first column names start and end.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    numbered = df.withColumn("_all", F.row_number().over(w)).where(test)
    island = numbered.withColumn("_island", F.col("_all") - F.row_number().over(w))
    out = island.groupBy(*keys, "_island").agg(F.min("_all").alias("run_start"), F.max("_all").alias("run_end"), F.count("*").alias("run_length"))
    return out.where(F.col("run_length") >= least).drop("_island")


def midpoint(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, y: str) -> DataFrame:
    """(keys, mid_x, mid_y): where half of the length of each line is reached.  Input has ``step`` and ``along``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = Window.partitionBy(*keys)
    d = df.withColumn("_half", F.max("along").over(whole) / 2).withColumn("_x", F.lag(x).over(w)).withColumn("_y", F.lag(y).over(w)).withColumn("_n", F.row_number().over(w))
    crossed = d.where((F.col("along") >= F.col("_half")) & F.col("_x").isNotNull())
    first = crossed.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy("_n"))).where("_rank = 1")
    t = F.coalesce(F.try_divide(F.col("_half") - (F.col("along") - F.col("step")), F.col("step")), F.lit(0.0))
    return first.select(*keys, (F.col("_x") + t * (F.col(x) - F.col("_x"))).alias("mid_x"), (F.col("_y") + t * (F.col(y) - F.col("_y"))).alias("mid_y"))


def similarity_sums(n: Column, sx: Column, sy: Column, su: Column, sv: Column, p: Column, q: Column, r: Column) -> tuple[Column, Column]:
    """(a, b) of u = a x - b y, v = b x + a y about the means, from sums; null where the points coincide."""
    den = r - (sx * sx + sy * sy) / n
    held = F.when(den > 1e-12, den)
    return (p - (sx * su + sy * sv) / n) / held, (q - (sx * sv - sy * su) / n) / held


_TERMS = {"sx": "x", "sy": "y", "su": "u", "sv": "v", "p": "x * u + y * v", "q": "x * v - y * u", "r": "x * x + y * y"}


def leave_one_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``error`` of each control point (x, y) -> (u, v) under the similarity fitted to the others of its group."""
    whole = Window.partitionBy(*keys)
    d = df.withColumn("n", F.count("*").over(whole) - 1)
    for name, term in _TERMS.items():
        d = d.withColumn(name, F.sum(F.expr(term)).over(whole) - F.expr(term))
    names = ("n", "sx", "sy", "su", "sv", "p", "q", "r")
    d = d.where("n > 0")
    a, b = similarity_sums(*[F.col(c) for c in names])
    d = d.withColumn("a", a).withColumn("b", b)
    dx, dy = F.col("x") - F.col("sx") / F.col("n"), F.col("y") - F.col("sy") / F.col("n")
    du = F.col("su") / F.col("n") + F.col("a") * dx - F.col("b") * dy - F.col("u")
    dv = F.col("sv") / F.col("n") + F.col("b") * dx + F.col("a") * dy - F.col("v")
    return d.withColumn("error", F.sqrt(du * du + dv * dv)).drop(*names, "a", "b")


def nearest_places(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: float, y: float, reach: float) -> DataFrame:
    """(keys, n, place, back): where a point goes into lines of points (keys, order, x, y), counted from both ends; null beyond ``reach``.

    It goes behind the nearest segment, the first of equals in the order of the line,
    and seen from the end into the same one.  Segments without length do not count.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    c = F.col
    d = df.withColumn("_i", F.row_number().over(w) - 1).withColumn("_bx", F.lead("x").over(w)).withColumn("_by", F.lead("y").over(w))
    dx, dy = c("_bx") - c("x"), c("_by") - c("y")
    square = dx * dx + dy * dy
    d = d.withColumn("_t", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((x - c("x")) * dx + (y - c("y")) * dy, square)))).withColumn("_able", square >= 1e-6)
    u, v = x - c("x") - c("_t") * dx, y - c("y") - c("_t") * dy
    g = d.groupBy(*keys).agg(F.count("*").alias("n"), F.min(F.when(c("_able"), F.struct(F.sqrt(u * u + v * v).alias("d"), c("_i").alias("i")))).alias("b"))
    near = c("b.d") <= reach
    return g.select(*keys, "n", F.when(near, c("b.i") + 1).alias("place"), F.when(near, c("n") - 1 - c("b.i")).alias("back"))
