"""Readers of what a page extraction left: drawings, text spans, raw segments, saved georeferences, page sizes."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.functions import color
from routeloom.operators.joins import best_per

# The red of routes, and page points of one map unit.
TARGET_RED = (237 / 255.0, 28 / 255.0, 36 / 255.0)
MAP_SCALE = 0.01

DRAWINGS = (
    "page_no INT, draw_index INT, type STRING, color ARRAY<DOUBLE>, fill ARRAY<DOUBLE>, width DOUBLE, dashes STRING, "
    "rect STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>, items ARRAY<STRUCT<op: STRING, pts: ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>>"
)
SPANS = "page_no INT, block_no INT, line_no INT, span_no INT, text STRING, box STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>, color INT, size DOUBLE"
SAVED = (
    "page_no INT, georef_panel_id STRING, frame_id STRING, corners_lonlat STRUCT<top_left: ARRAY<DOUBLE>, top_right: ARRAY<DOUBLE>, bottom_right: ARRAY<DOUBLE>, bottom_left: ARRAY<DOUBLE>>, "
    "pdf_panel_bbox STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>, pdf_frame_bbox STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>, "
    "frame STRUCT<bbox_pt: STRUCT<x0: DOUBLE, y0: DOUBLE, x1: DOUBLE, y1: DOUBLE>>"
)


def _extracted(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schema).json(path)


def read_drawings(spark: SparkSession, path: str) -> DataFrame:
    """Drawings of all pages, extracted beforehand, from Parquet or lines of JSON."""
    return _extracted(spark, path, DRAWINGS)


def red_drawings(drawings: DataFrame, target: Sequence[float] = TARGET_RED, limit: float = 0.08) -> DataFrame:
    """Drawings whose stroke or fill is within ``limit`` of the red of routes."""
    red = F.array(*[F.lit(float(v)) for v in target])
    return drawings.where(color.close_to(color.rgb(F.col("color")), color.rgb(F.col("fill")), red, limit))


def read_spans(spark: SparkSession, path: str) -> DataFrame:
    """Text spans of all pages, extracted beforehand; ``labels.text_lines`` joins them to lines."""
    return _extracted(spark, path, SPANS)


def raw_segments(features: DataFrame) -> DataFrame:
    """Segments back from the features of ``read_geojson``: page points, and review reasons as a list."""
    p = lambda name: F.col("properties")[name]
    back = F.transform(F.col("lines")[0], lambda q: F.struct((q["x"] / MAP_SCALE).alias("x"), (-q["y"] / MAP_SCALE).alias("y")))
    return features.where("geometry_type = 'LineString'").select(
        p("segment_id").alias("segment_id"), p("page_no").cast("int").alias("page_no"), F.nullif(p("frame_id"), F.lit("")).alias("frame_id"),
        F.lit(0).alias("draw_index"), p("style_class").alias("style_class"), p("classification").alias("classification"), p("width_pt").cast("double").alias("width_pt"),
        p("dashes").alias("dashes"), back.alias("points"), p("length_pt").cast("double").alias("length_pt"), p("confidence").cast("double").alias("confidence"),
        F.coalesce(p("needs_manual_review").cast("boolean"), F.lit(False)).alias("needs_manual_review"),
        F.filter(F.split(F.coalesce(p("review_reasons"), F.lit("")), ","), lambda r: r != "").alias("review_reasons"),
    )


def read_saved_georefs(spark: SparkSession, folder: str) -> DataFrame:
    """The saved georeference of each panel; files that are no JSON or name no panel go, of several files the last by name counts."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="page_*_*.json").select(F.input_file_name().alias("path"), F.from_json("value", SAVED).alias("s"))
    d = raw.select("path", "s.*").withColumn("panel", F.coalesce("georef_panel_id", "frame_id")).where("page_no is not null and panel is not null and panel <> ''")
    return best_per(d, ["page_no", "panel"], F.desc("path"))


def saved_corner(name: str) -> Column:
    """STRUCT<x, y> of a saved corner."""
    c = F.col(f"corners_lonlat.{name}")
    return F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y"))


def read_settings(path: str, environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """``key=value`` lines of a driver's settings file; blank lines and comments go, quotes around a value too, and what the environment has wins."""
    found: dict[str, str] = {}
    file = Path(path)
    for line in file.read_text(encoding="utf-8").splitlines() if file.exists() else []:
        key, mark, value = line.strip().partition("=")
        if mark and key.strip() and not key.startswith("#"):
            found[key.strip()] = value.strip().strip("'\"")
    held = os.environ if environment is None else environment
    return {k: held.get(k, v) for k, v in found.items()}


def first_existing(*paths: str | None) -> str | None:
    """The first of the paths that exists."""
    return next((p for p in paths if p and Path(p).exists()), None)
