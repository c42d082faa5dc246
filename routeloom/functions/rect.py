"""Rectangle column expressions over STRUCT<x0, y0, x1, y1>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rect(x0, y0, x1, y1) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def area(r: Column) -> Column:
    return F.greatest(F.lit(0.0), r["x1"] - r["x0"]) * F.greatest(F.lit(0.0), r["y1"] - r["y0"])


def shared_area(a: Column, b: Column) -> Column:
    wide = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    high = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(F.lit(0.0), wide) * F.greatest(F.lit(0.0), high)


def iou(a: Column, b: Column) -> Column:
    both = shared_area(a, b)
    return F.coalesce(F.try_divide(both, area(a) + area(b) - both), F.lit(0.0))


def overlap_ratio(a: Column, b: Column) -> Column:
    """Share of ``a`` that lies in ``b``."""
    return shared_area(a, b) / F.greatest(area(a), F.lit(1e-6))


def contains(outer: Column, inner: Column, tolerance: float = 0.0) -> Column:
    return (
        (outer["x0"] - tolerance <= inner["x0"]) & (outer["y0"] - tolerance <= inner["y0"]) & (outer["x1"] + tolerance >= inner["x1"]) & (outer["y1"] + tolerance >= inner["y1"])
    )


def holds_point(r: Column, x: Column, y: Column, margin: float = 0.0) -> Column:
    return x.between(r["x0"] - margin, r["x1"] + margin) & y.between(r["y0"] - margin, r["y1"] + margin)


def gap(a: Column, b: Column) -> Column:
    """Distance between two rectangles; 0 where they touch."""
    dx = F.greatest(F.lit(0.0), a["x0"] - b["x1"], b["x0"] - a["x1"])
    dy = F.greatest(F.lit(0.0), a["y0"] - b["y1"], b["y0"] - a["y1"])
    return F.hypot(dx, dy)


def point_gap(r: Column, x: Column, y: Column) -> Column:
    return F.hypot(F.greatest(F.lit(0.0), r["x0"] - x, x - r["x1"]), F.greatest(F.lit(0.0), r["y0"] - y, y - r["y1"]))
