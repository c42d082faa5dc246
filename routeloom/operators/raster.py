"""Pixel tables (page, x, y, r, g, b): red masks, dilation, bounds, crops and neighbourhood shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least red and least lead of red over green and blue, or most green and blue.
MASKS = ("page", "near_route", "overlay")


def is_red(r: Column, g: Column, b: Column, kind: str = "page") -> Column:
    """Red by one of three thresholds: masks of pages, shares near a route, overlays."""
    if kind == "page":
        return (r >= 140) & (r - g >= 30) & (r - b >= 30)
    if kind == "near_route":
        return (r >= 140) & (r - g >= 35) & (r - b >= 35)
    if kind == "overlay":
        return (r >= 180) & (g < 110) & (b < 110)
    raise ValueError(f"kind must be one of {MASKS}")


def red_mask(pixels: DataFrame, kind: str = "page") -> DataFrame:
    return pixels.where(is_red(F.col("r"), F.col("g"), F.col("b"), kind)).select("page", "x", "y")


def dilate(mask: DataFrame, size: int = 5, width: int | None = None, height: int | None = None) -> DataFrame:
    """Cells within a square of ``size`` (odd) around a cell of the mask, inside the image where its size is given."""
    if size <= 1:
        return mask.select("page", "x", "y").distinct()
    around = F.sequence(F.lit(-(size // 2)), F.lit(size // 2))
    rows = mask.select("page", F.col("x"), F.explode(around).alias("dy"), "y").select("page", "x", (F.col("y") + F.col("dy")).alias("y")).distinct()
    out = rows.select("page", F.explode(around).alias("dx"), "x", "y").select("page", (F.col("x") + F.col("dx")).alias("x"), "y").distinct()
    if width is not None:
        out = out.where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))
    return out


def mask_bounds(mask: DataFrame, margin: int = 0, width: int = 2**31 - 1, height: int = 2**31 - 1) -> DataFrame:
    """(page, x0, y0, x1, y1): bounds of the mask, the far ones exclusive, widened by ``margin`` inside the image; pages without a cell have none."""
    d = mask.groupBy("page").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1"))
    low = lambda c: F.greatest(F.lit(0), F.col(c) - margin).alias(c)
    high = lambda c, most: F.least(F.lit(most).cast("long"), F.col(c) + margin).alias(c)
    return d.select("page", low("x0"), low("y0"), high("x1", width), high("y1", height))


def crop(pixels: DataFrame, bounds: DataFrame) -> DataFrame:
    """Pixels within the bounds of their page, counted from the corner of these."""
    d = pixels.join(F.broadcast(bounds), "page").where("x >= x0 and x < x1 and y >= y0 and y < y1")  # a row a page
    return d.withColumn("x", F.col("x") - F.col("x0")).withColumn("y", F.col("y") - F.col("y0")).drop("x0", "y0", "x1", "y1")


def red_share(points: DataFrame, pixels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, red_ratio): share of red among the pixels of the image in the 3 x 3 squares around points (keys, page, x, y); 0 without any."""
    around = F.sequence(F.lit(-1), F.lit(1))
    spots = points.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around))
    spots = spots.select(*keys, "page", (F.round("x").cast("long") + F.col("dx")).alias("x"), (F.round("y").cast("long") + F.col("dy")).alias("y"))
    seen = pixels.select("page", F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), is_red(F.col("r"), F.col("g"), F.col("b"), "near_route").alias("red"))
    d = spots.join(seen, ["page", "x", "y"], "left").groupBy(*keys).agg(F.avg(F.col("red").cast("double")).alias("share"))
    return d.select(*keys, F.coalesce("share", F.lit(0.0)).alias("red_ratio"))


def first_source(pdf: Column, png: Column) -> Column:
    """Where a page's picture comes from: the PDF, else the PNG, else a blank page."""
    return F.coalesce(F.when(pdf.isNotNull(), "pdf"), F.when(png.isNotNull(), "png"), F.lit("blank"))
