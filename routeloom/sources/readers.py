"""Readers for the file shapes of the map workflow, with schemas stated and nothing inferred."""

from __future__ import annotations

import csv
import html
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from routeloom.operators.joins import best_per

ANCHORS = "page_no INT, frame_id STRING, page_height_pt DOUBLE, gcps ARRAY<STRUCT<index INT, name STRING, role STRING, pdf_x DOUBLE, pdf_y DOUBLE, raw_pdf_y_top_left DOUBLE, longitude DOUBLE, latitude DOUBLE>>"
FEATURES = "type STRING, features ARRAY<STRUCT<type STRING, properties MAP<STRING, STRING>, geometry STRUCT<type STRING, coordinates STRING>>>"
ROADS = "elements ARRAY<STRUCT<type STRING, id BIGINT, tags MAP<STRING, STRING>, geometry ARRAY<STRUCT<lat DOUBLE, lon DOUBLE>>>>"


def read_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; empty text is null."""
    return spark.read.csv(path, header=True, schema=schema, nullValue="", mode="PERMISSIVE")


def as_int(c: Column) -> Column:
    """Whole number from text that may be written as a decimal."""
    return c.try_cast("double").cast("int")


def read_encoded_rows(spark: SparkSession, path: str, encoding: str = "cp932") -> DataFrame:
    """(row_no, cells) of a CSV in an encoding that Spark's reader lacks.

    Bad bytes are replaced; the header and empty records go.  ``row_no`` counts
    records from 1, however many lines a quoted cell takes.  A file is one record here: such files are lists of places.
    """

    @F.pandas_udf("array<array<string>>")
    def records(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: [r for r in csv.reader(io.StringIO(bytes(b).decode(encoding, "replace"), newline="")) if r][1:])

    files = spark.read.format("binaryFile").load(path).select(records("content").alias("rows"))
    return files.select(F.posexplode("rows").alias("at", "cells")).select((F.col("at") + 1).alias("row_no"), "cells")


def read_matches(spark: SparkSession, path: str, pattern: str, names: list[str]) -> DataFrame:
    """A row for each match of ``pattern`` in whole text files; groups by name, entities unescaped."""

    @F.pandas_udf(StringType())
    def plain(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else html.unescape(t))

    groups = [F.regexp_extract_all("value", F.lit(pattern), F.lit(k + 1)).alias(n) for k, n in enumerate(names)]
    rows = spark.read.text(path, wholetext=True).select(F.explode(F.arrays_zip(*groups)).alias("m"))
    return rows.select(*[plain(F.col("m")[n]).alias(n) for n in names])


def read_geojson(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(properties, geometry_type, lines) of the features; a LineString is one line, other kinds have none."""
    f = spark.read.json(path, schema=FEATURES, multiLine=True).select(F.explode("features").alias("f"))
    kind, raw = F.col("f.geometry.type"), F.col("f.geometry.coordinates")
    one, many = F.from_json(raw, "array<array<double>>"), F.from_json(raw, "array<array<array<double>>>")
    lines = F.when(kind == "LineString", F.array(one)).when(kind.isin("MultiLineString", "Polygon"), many)
    points = F.transform(lines, lambda line: F.transform(line, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return f.select(F.col("f.properties").alias("properties"), kind.alias("geometry_type"), points.alias("lines"))


def read_anchor_files(spark: SparkSession, folder: str, heights: DataFrame | None = None) -> DataFrame:
    """One row a file: path, its anchors, and status.

    Status, the first that holds: invalid_json, skipped_variant (its name is not that of
    its page and frame), skipped_no_frame_anchor (no point has the role), skipped_no_page_height
    (neither the file nor ``heights``, (page_no, page_height), has one), imported.
    """
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(F.input_file_name().alias("path"), F.from_json("value", ANCHORS).alias("a"))
    none = F.array().cast("array<struct<index:int,name:string,role:string,pdf_x:double,pdf_y:double,raw_pdf_y_top_left:double,longitude:double,latitude:double>>")
    given = lambda g: (g["role"] == "frame_anchor") & g["pdf_x"].isNotNull() & g["longitude"].isNotNull() & g["latitude"].isNotNull()
    raw = raw.select("path", F.col("a.page_no").alias("page_no"), F.col("a.frame_id").alias("frame_id"), F.col("a.page_height_pt").alias("page_height"), F.filter(F.coalesce("a.gcps", none), given).alias("anchors"))
    if heights is not None:
        known = heights.withColumnRenamed("page_height", "_height")
        raw = raw.join(F.broadcast(known), "page_no", "left").withColumn("page_height", F.coalesce("_height", "page_height")).drop("_height")  # a row a page
    expected = F.format_string("page_%03d_%s.json", F.col("page_no"), F.col("frame_id"))
    canonical = F.coalesce(F.element_at(F.split("path", "/"), -1) == expected, F.lit(False))
    status = (
        F.when(F.col("page_no").isNull(), "invalid_json").when(~canonical, "skipped_variant").when(F.size("anchors") == 0, "skipped_no_frame_anchor").when(F.col("page_height").isNull(), "skipped_no_page_height").otherwise("imported")
    )
    return raw.select("path", "page_no", "frame_id", "page_height", "anchors", status.alias("status"), canonical.alias("canonical"))


def best_anchor_files(files: DataFrame) -> DataFrame:
    """The best file of each frame: one with anchors, of the plain name, with most anchors, last by name; templates are skipped."""
    usable = files.where(~F.col("path").contains(".template.") & F.col("frame_id").isNotNull())
    return best_per(usable, ["page_no", "frame_id"], F.when(F.size("anchors") > 0, 0).otherwise(1), F.col("canonical").desc(), F.size("anchors").desc(), F.desc("path"))


def read_roads(spark: SparkSession, path: str) -> DataFrame:
    """(way_id, highway, name, points) of cached road ways with at least two nodes."""
    e = spark.read.json(path, schema=ROADS, multiLine=True).select(F.explode("elements").alias("e")).where("e.type = 'way' and size(e.geometry) >= 2")
    return e.select(F.col("e.id").alias("way_id"), F.col("e.tags")["highway"].alias("highway"), F.col("e.tags")["name"].alias("name"), F.transform("e.geometry", lambda g: F.struct(g["lon"].alias("x"), g["lat"].alias("y"))).alias("points"))
