"""Geographic column expressions: distances, projections, windows of plausibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 equatorial radius, Mercator latitude limit, plausible region and spans.
EARTH_M = 6378137.0
MERCATOR_LIMIT = 85.05112878
REGION = (131.0, 135.6, 32.0, 35.2)
SPANS = (1.8, 1.5)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres between two lon/lat points."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_M * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Web Mercator metres; the latitude is clamped."""
    held = F.greatest(F.lit(-MERCATOR_LIMIT), F.least(F.lit(MERCATOR_LIMIT), lat))
    return EARTH_M * F.radians(lon), EARTH_M * F.ln(F.tan(F.lit(0.7853981633974483) + F.radians(held) / 2))


def mercator_inverse(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / EARTH_M), F.degrees(2 * F.atan(F.exp(y / EARTH_M)) - 1.5707963267948966)


def equirect(lon: Column, lat: Column, ref_lon: Column, ref_lat: Column) -> tuple[Column, Column]:
    """Metres in the local equirectangular plane about a reference point."""
    return F.radians(lon - ref_lon) * EARTH_M * F.cos(F.radians(ref_lat)), F.radians(lat - ref_lat) * EARTH_M


def equirect_inverse(x: Column, y: Column, ref_lon: Column, ref_lat: Column) -> tuple[Column, Column]:
    return ref_lon + F.degrees(x / (EARTH_M * F.cos(F.radians(ref_lat)))), ref_lat + F.degrees(y / EARTH_M)


def plausible(min_lon: Column, max_lon: Column, min_lat: Column, max_lat: Column, region=REGION, spans=SPANS) -> Column:
    """Inside the region, and no wider than the spans."""
    west, east, south, north = region
    inside = (min_lon >= west) & (max_lon <= east) & (min_lat >= south) & (max_lat <= north)
    return inside & (max_lon - min_lon <= spans[0]) & (max_lat - min_lat <= spans[1])


def segment_offset(px: Column, py: Column, ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """STRUCT<t, distance>: clamped projection of a point on a segment (a point where it has no length)."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    t = F.when(square <= 1e-12, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide((px - ax) * dx + (py - ay) * dy, square))))
    return F.struct(t.alias("t"), F.hypot(px - (ax + t * dx), py - (ay + t * dy)).alias("distance"))


def turn_score(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Cosine between two directions; -1 where one has no length."""
    size = F.hypot(ax, ay) * F.hypot(bx, by)
    return F.when(size <= 1e-9, F.lit(-1.0)).otherwise(F.try_divide(ax * bx + ay * by, size))


def zoom_level(span_lon: Column, span_lat: Column, low: float = 6.0, high: float = 17.0) -> Column:
    """Map zoom for an extent in degrees, clamped."""
    widest = F.greatest(span_lon, span_lat, F.lit(1e-6))
    return F.greatest(F.lit(low), F.least(F.lit(high), F.floor(F.log2(F.lit(360.0) / widest))))
