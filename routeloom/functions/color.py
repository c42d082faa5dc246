"""Colour column expressions over ARRAY<DOUBLE> of red, green, blue from 0 to 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rgb(color: Column) -> Column:
    """Three components: a single grey value is widened, longer arrays are cut."""
    return F.when(F.size(color) == 1, F.array_repeat(color[0], 3)).when(F.size(color) >= 3, F.slice(color, 1, 3))


def l1_distance(a: Column, b: Column) -> Column:
    """Sum of absolute differences; null where either is null."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, x: s + x)


def close_to(stroke: Column, fill: Column, target: Column, limit: float = 0.08) -> Column:
    """Stroke or fill within ``limit`` of ``target``; nulls are far."""
    return F.coalesce(l1_distance(stroke, target) <= limit, F.lit(False)) | F.coalesce(l1_distance(fill, target) <= limit, F.lit(False))


def mean(c: Column) -> Column:
    return F.coalesce((c[0] + c[1] + c[2]) / 3, F.lit(0.0))


def spread(c: Column) -> Column:
    return F.coalesce(F.array_max(c) - F.array_min(c), F.lit(0.0))


def near_white(c: Column) -> Column:
    return c.isNotNull() & (mean(c) >= 0.985) & (spread(c) <= 0.03)


def pale_fill(c: Column) -> Column:
    return c.isNotNull() & F.coalesce(F.array_min(c) >= 0.75, F.lit(False)) & (mean(c) >= 0.82) & ~near_white(c)


def dark(c: Column) -> Column:
    return c.isNotNull() & (mean(c) <= 0.28)


def bluish(c: Column) -> Column:
    return F.coalesce((c[2] >= 0.65) & (c[0] <= 0.2) & (c[1] <= 0.75), F.lit(False))


def hex_of(packed: Column) -> Column:
    """#rrggbb of a packed 24-bit number."""
    return F.concat(F.lit("#"), F.lower(F.lpad(F.hex(packed), 6, "0")))
