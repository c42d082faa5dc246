"""Polyline column expressions over ARRAY<STRUCT<x, y>>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def bezier(p0: Column, p1: Column, p2: Column, p3: Column, steps: int = 16) -> Column:
    """``steps + 1`` points of a cubic Bezier curve."""

    def at(i: Column) -> Column:
        t = i / float(steps)
        u = 1 - t
        weights = (u * u * u, 3 * u * u * t, 3 * u * t * t, t * t * t)
        mixed = [sum((w * p[c] for w, p in zip(weights, (p0, p1, p2, p3), strict=True)), F.lit(0.0)) for c in ("x", "y")]
        return point(*mixed)

    return F.transform(F.sequence(F.lit(0), F.lit(steps)), at)


def steps_of(points: Column) -> Column:
    """Lengths between neighbouring points."""
    ahead = F.slice(points, 2, F.greatest(F.size(points) - 1, F.lit(0)))
    behind = F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0)))
    return F.zip_with(behind, ahead, lambda a, b: F.hypot(b["x"] - a["x"], b["y"] - a["y"]))


def length(points: Column) -> Column:
    return F.aggregate(steps_of(points), F.lit(0.0), lambda s, x: s + x)


def round_points(points: Column, digits: int = 7) -> Column:
    return F.transform(points, lambda p: point(F.round(p["x"], digits), F.round(p["y"], digits)))


def geojson_geometry(lines: Column) -> Column:
    """GeoJSON text: a LineString for one line, a MultiLineString for more."""
    pairs = F.transform(lines, lambda line: F.transform(line, lambda p: F.array(p["x"], p["y"])))
    one = F.to_json(F.struct(F.lit("LineString").alias("type"), F.element_at(pairs, 1).alias("coordinates")))
    many = F.to_json(F.struct(F.lit("MultiLineString").alias("type"), pairs.alias("coordinates")))
    return F.when(F.size(lines) == 1, one).otherwise(many)


def segments_of(points: Column) -> Column:
    """ARRAY<STRUCT<index, a, b>> of the neighbouring points of a line; none for fewer than two."""
    n = F.size(points)
    pair = lambda k: F.struct((k - 1).alias("index"), F.get(points, k - 1).alias("a"), F.get(points, k).alias("b"))
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), pair)).otherwise(F.filter(F.transform(points, lambda p: F.struct(F.lit(0).alias("index"), p.alias("a"), p.alias("b"))), lambda s: F.lit(False)))


def joined(lines: Column) -> Column:
    """Samples of several lines in a row; the first sample of a line goes if there were samples before."""
    empty = F.filter(F.flatten(lines), lambda p: F.lit(False))
    return F.aggregate(lines, empty, lambda s, line: F.concat(s, F.when((F.size(s) > 0) & (F.size(line) > 0), F.slice(line, 2, F.greatest(F.size(line), F.lit(1)))).otherwise(line)))


def without_short(lines: Column, least: float = 4.0) -> Column:
    """The lines of at least ``least`` in length."""
    return F.filter(lines, lambda points: length(points) >= least)


def insert_index(points: Column, x: Column, y: Column, reach: float = 12.0) -> Column:
    """Place at which a point would be put into a line: behind the nearest segment within ``reach``, the first of equals; null without one.

    Segments without length do not count.
    """
    from routeloom.functions.geo import segment_offset

    sized = F.filter(segments_of(points), lambda s: F.pow(s["b"]["x"] - s["a"]["x"], 2) + F.pow(s["b"]["y"] - s["a"]["y"], 2) >= 1e-6)
    away = F.transform(sized, lambda s: F.struct(segment_offset(x, y, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])["distance"].alias("distance"), s["index"].alias("index")))
    best = F.array_min(away)
    return F.when(best["distance"] <= reach, best["index"] + 1)
