"""Writers: rows as CSV, features as one GeoJSON line each, logs and reports as one small text."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routeloom.functions.line import geojson_geometry


def write_rows(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header, of the named columns; an empty table still has its header."""
    (df.select(*columns) if columns else df).write.mode("overwrite").csv(path, header=True, emptyValue="", nullValue="")


def feature(lines: Column, properties: Column) -> Column:
    """GeoJSON text of a feature."""
    return F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(properties), F.lit(',"geometry":'), geojson_geometry(lines), F.lit("}"))


def write_features(df: DataFrame, path: str, lines: str, properties: Sequence[str]) -> None:
    """A feature a line, so that files of any size are read and written in parallel."""
    df.select(feature(F.col(lines), F.struct(*properties)).alias("value")).write.mode("overwrite").text(path)


def point_feature(x: Column, y: Column, properties: Column) -> Column:
    """GeoJSON text of a point."""
    geometry = F.to_json(F.struct(F.lit("Point").alias("type"), F.array(x, y).alias("coordinates")))
    return F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(properties), F.lit(',"geometry":'), geometry, F.lit("}"))


def link_feature(x0: Column, y0: Column, x1: Column, y1: Column, properties: Column) -> Column:
    """GeoJSON text of the straight line between two places."""
    ends = F.array(F.struct(x0.alias("x"), y0.alias("y")), F.struct(x1.alias("x"), y1.alias("y")))
    return feature(F.array(ends), properties)


def worst_points(samples: DataFrame) -> DataFrame:
    """Point features of samples (lon, lat, route_id, sample_index, nearest_m, highway, failed)."""
    return samples.select(point_feature(F.col("lon"), F.col("lat"), F.struct("route_id", "sample_index", "nearest_m", "highway", "failed")).alias("value"))


def snap_links(samples: DataFrame, least: float = 0.01) -> DataFrame:
    """Lines from samples to where they were snapped, for those that moved more than ``least`` metres."""
    moved = samples.where(F.col("snapped") & (F.col("snap_m") > least))
    return moved.select(link_feature(F.col("lon"), F.col("lat"), F.col("snap_lon"), F.col("snap_lat"), F.struct("route_id", "sample_index", "snap_m", "highway", "way_id")).alias("value"))


def residual_links(points: DataFrame) -> DataFrame:
    """Lines from targets to fitted places; points without a fit have none."""
    fitted = points.where("fit_lon is not null")
    return fitted.select(link_feature(F.col("lon"), F.col("lat"), F.col("fit_lon"), F.col("fit_lat"), F.struct("combo", "index", "name", "fit_m", "loocv_m")).alias("value"))


def anchor_features(anchors: DataFrame) -> DataFrame:
    """Three features an anchor (index, name, lon, lat, fit_lon, fit_lat): target, fitted place, and the way between."""
    about = lambda kind: F.struct("index", "name", F.lit(kind).alias("point_kind"))
    here, there = (F.col("lon"), F.col("lat")), (F.col("fit_lon"), F.col("fit_lat"))
    three = F.array(point_feature(*here, about("target")), point_feature(*there, about("fit_pred")), link_feature(*here, *there, about("residual_vector")))
    return anchors.select("index", F.posexplode(three).alias("part", "value"))


def panel_collections(routes: DataFrame) -> DataFrame:
    """(panel, value): the GeoJSON collection of each panel's routes (panel, route_id, points) of two points or more."""
    drawn = routes.where(F.size("points") >= 2)
    text = feature(F.array("points"), F.struct("panel", "route_id"))
    rows = drawn.select("panel", F.struct("route_id", text.alias("text")).alias("f")).groupBy("panel").agg(F.sort_array(F.collect_list("f")).alias("f"))
    body = F.array_join(F.transform("f", lambda f: f["text"]), ",")
    return rows.select("panel", F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("value"))


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text (a log, a report) as one part file in a folder that all machines see."""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def write_log(spark: SparkSession, entries: Mapping[str, object], path: str) -> None:
    write_text(spark, json.dumps(entries, ensure_ascii=False, indent=2, sort_keys=True, default=str), path)


def counts(df: DataFrame, key: str) -> dict[str, int]:
    """Rows by value of a column of few values (a class, a status, a model); null counts as the empty text."""
    rows = df.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k")).count().collect()
    return dict(sorted((r["k"], r["count"]) for r in rows))


def report(title: str, facts: Mapping[str, object], sections: Mapping[str, Mapping[str, int]]) -> str:
    """Markdown of single facts and counted sections."""
    lines = [f"# {title}", "", *[f"- {k}: `{v}`" for k, v in facts.items()]]
    for name, rows in sections.items():
        lines += ["", f"## {name}", *[f"- {k}: `{v}`" for k, v in rows.items()]]
    return "\n".join(lines) + "\n"
