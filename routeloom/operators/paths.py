"""Drawing operators of a path: lengths by operator, separate and joined polylines, cells a line covers.

Items are rows (keys, seq, op, pts), ``pts`` an ARRAY<STRUCT<x, y>>: ``l`` has its two
ends, ``c`` four control points, ``re`` two corners, ``qu`` the corners ul, ur, lr, ll,
and ``h``, which closes the path, none.  ``seq`` orders the items of a drawing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from routeloom.functions import line
from routeloom.session import ship

#: Fixed value: points nearer than this are one.
SAME_POINT = 0.01
#: Slack of the stretch that is looked at.
RIM = 1e-5
EMPTY = "array<struct<x:double,y:double>>"


def op_points(op: Column, pts: Column) -> Column:
    """The polyline of one item; null for ``h`` and unknown operators."""
    at = [F.get(pts, k) for k in range(4)]
    a, b = at[0], at[1]
    box = F.array(a, line.point(b["x"], a["y"]), b, line.point(a["x"], b["y"]), a)
    return F.when(op == "l", F.array(a, b)).when(op == "c", line.bezier(*at)).when(op == "re", box).when(op == "qu", F.array(*at, a))


def path_metrics(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, length, segments, curves, closed): an ``h`` closes but has no length of its own."""
    op = F.col("op")
    boxed = op.isin("re", "qu")
    return items.groupBy(*keys).agg(
        F.coalesce(F.sum(line.length(op_points(op, F.col("pts")))), F.lit(0.0)).alias("length"),
        F.sum(F.when(boxed, 4).when(op.isin("l", "c"), 1).otherwise(0)).alias("segments"),
        F.count_if(op == "c").alias("curves"),
        F.count_if(boxed | (op == "h")).alias("closed"),
    )


def _traced(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items with ``pl`` (own polyline), ``began`` (start of their path) and ``before`` (end of the last stroke in it)."""
    order = Window.partitionBy(*keys).orderBy("seq")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    stroke = F.col("op").isin("l", "c")
    d = items.withColumn("pl", op_points(F.col("op"), F.col("pts")))
    d = d.withColumn("_path", F.coalesce(F.count_if(F.col("op").isin("re", "qu", "h")).over(earlier), F.lit(0)))
    inside = Window.partitionBy(*keys, "_path").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("began", F.first(F.when(stroke, F.get("pl", F.lit(0))), ignorenulls=True).over(inside))
    return d.withColumn("before", F.last(F.when(stroke, F.element_at("pl", -1)), ignorenulls=True).over(inside))


def separate_lines(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, seq, points): a polyline for each item, and for an ``h`` the way back where its path is open."""
    d = _traced(items, keys)
    back = F.when((F.col("op") == "h") & (F.col("began") != F.col("before")), F.array("before", "began"))
    return d.select(*keys, "seq", F.coalesce("pl", back).alias("points")).where("points is not null")


def joined_lines(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, line_no, points): strokes that begin where the last one ended make one polyline.

    A rectangle or quad stands alone; an ``h`` adds the start of its path, unless the
    path is closed already, and ends the polyline.
    """
    far = lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"]) > SAME_POINT
    d = _traced(items, keys)
    stroke, began, before = F.col("op").isin("l", "c"), F.col("began"), F.col("before")
    fresh = (F.col("op").isin("re", "qu") | (stroke & (before.isNull() | far(before, F.get("pl", F.lit(0)))))).cast("int")
    closing = F.when((F.col("op") == "h") & far(before, began), F.array("began"))
    d = d.withColumn("_new", fresh).withColumn("_piece", F.when((F.col("_new") == 1) | ~stroke, F.coalesce("pl", closing)).otherwise(F.slice("pl", 2, 99)))
    d = d.withColumn("line_no", F.sum("_new").over(Window.partitionBy(*keys).orderBy("seq"))).where("_piece is not null")
    lines = d.groupBy(*keys, "line_no").agg(F.sort_array(F.collect_list(F.struct("seq", "_piece"))).alias("_p"))
    return lines.select(*keys, "line_no", F.flatten(F.transform("_p", lambda p: p["_piece"])).alias("points"))


def covered_cells(lines: DataFrame, keys: Sequence[str], width: float = 6.0) -> DataFrame:
    """(keys, cx, cy): grid cells whose whole-number centre is within half of ``width`` of a line; a single point fills a disc of radius ``width``.

    Lines: (keys, points).  Row by row the stretch that a segment covers is computed
    whole, and stretches are merged before they become cells, so work grows with the
    height of the lines and the cells that come out, not with how often these are covered.
    Distances count to a millionth, so that rounding does not decide at the rim.
    """
    n = F.size("points")
    ends = F.when(n == 1, F.array(F.struct(F.get("points", F.lit(0)).alias("a"), F.get("points", F.lit(0)).alias("b"), F.lit(float(width)).alias("r"))))
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.struct(F.get("points", k - 1).alias("a"), F.get("points", k).alias("b"), F.lit(width / 2).alias("r")))
    d = lines.select(*keys, F.explode(F.when(n > 1, pairs).otherwise(ends)).alias("s"))
    d = d.select(*keys, F.col("s.a.x").alias("ax"), F.col("s.a.y").alias("ay"), F.col("s.b.x").alias("bx"), F.col("s.b.y").alias("by"), F.col("s.r").alias("r"))
    c = F.col
    d = d.where("ax is not null and ay is not null and bx is not null and by is not null")
    ship(d.sparkSession)
    d = d.select(*keys, "ax", "ay", "bx", "by", "r").repartition(2 * d.sparkSession.sparkContext.defaultParallelism)
    schema = StructType([*(d.schema[k] for k in keys), StructField("cy", LongType()), StructField("_low", LongType()), StructField("_high", LongType())])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                at, y, low, high = _stretches(*[part[name].to_numpy() for name in ("ax", "ay", "bx", "by", "r")])
                picked = pa.array(at)
                yield pa.RecordBatch.from_arrays([*[part[name].take(picked) for name in keys], pa.array(y), pa.array(low), pa.array(high)], schema=to_arrow_schema(schema))

    # of stretches that begin together the longest is enough; what the ones before have is left out
    d = d.mapInArrow(stretches, schema).groupBy(*keys, "cy", "_low").agg(F.max("_high").alias("_high"))
    before = Window.partitionBy(*keys, "cy").orderBy("_low").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_low", F.greatest("_low", F.max("_high").over(before) + 1)).where("_low <= _high")
    return d.select(*keys, F.explode(F.sequence("_low", "_high")).alias("cx"), "cy")


def _stretches(ax, ay, bx, by, r) -> tuple[np.ndarray, ...]:
    """(segment, row, lowest, highest): cells of whole numbers that count as at most ``r`` from a segment to a millionth.

    What is so near is convex: the discs around both ends and the strip between them.
    """
    top = np.floor(np.maximum(ay, by) + r + RIM).astype(np.int64)
    rows = np.maximum(0, top - np.ceil(np.minimum(ay, by) - r - RIM).astype(np.int64) + 1)
    at = np.repeat(np.arange(len(ax)), rows)
    y = np.repeat(top, rows) - (np.arange(len(at)) - np.repeat(np.cumsum(rows) - rows, rows))
    far = np.floor(r * 1e6 + 1e-3) / 1e6 + 5e-7
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    with np.errstate(all="ignore"):
        lean, half, rise, run = (v[at] for v in (dx / dy, far * np.sqrt(square) / np.abs(dy), dy / dx, square / dx))
        a, b, f, level, upright = y - ay[at], y - by[at], far[at], (dy == 0)[at], (dx == 0)[at]
        near_a, near_b = np.abs(a) < f, np.abs(b) < f
        wide_a, wide_b = np.sqrt(f * f - a * a), np.sqrt(f * f - b * b)
        xa, xb = ax[at], bx[at]
        middle, end = xa + a * lean, xa - a * rise
        # beside the line by less than ``far``, and along it between its ends
        left = np.where(level, -np.inf, middle - half), np.where(upright, -np.inf, np.minimum(end, end + run))
        right = np.where(level, np.inf, middle + half), np.where(upright, np.inf, np.maximum(end, end + run))
        left, right = np.maximum(*left), np.minimum(*right)
        between = (y >= np.minimum(ay, by)[at]) & (y <= np.maximum(ay, by)[at])
        strip = (square > 1e-12)[at] & (left <= right) & (~level | near_a) & (~upright | between)
    low = np.minimum(np.where(near_a, xa - wide_a, np.inf), np.minimum(np.where(near_b, xb - wide_b, np.inf), np.where(strip, left, np.inf)))
    high = np.maximum(np.where(near_a, xa + wide_a, -np.inf), np.maximum(np.where(near_b, xb + wide_b, -np.inf), np.where(strip, right, -np.inf)))
    low, high = np.ceil(low), np.floor(high)
    kept = low <= high
    return at[kept], y[kept], low[kept].astype(np.int64), high[kept].astype(np.int64)
