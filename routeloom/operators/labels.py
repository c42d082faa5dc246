"""Operators over labels and markers of a page: text lines, readings, marker clusters, gazetteer entries."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from routeloom.functions import rect, text
from routeloom.operators import tiles

# Dash patterns of routes; largest side of a small drawing; marker search, cluster and score limits.
ROUTE_DASHES = ("[ .05 2.5 ] 0", "[ .02 3 ] 0")
SMALL_SIDES = (0.3, 28.0)
MARKER_REACH, CLUSTER_REACH, LEAST_SCORE, SCORE_WINDOW = 42.0, 8.0, 1.25, 1.25
READING_REACH, READING_SCORE = 26.0, 0.7


def text_lines(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, text, box, color, font_size): the spans of a line, but for blank ones, joined in order.

    Spans: (keys, span_no, text, box, color, size).  The colour is the most frequent one,
    of equally frequent ones the first; the font size is the largest.
    """
    seen = spans.where(F.col("text").rlike(r"\S"))
    per = seen.groupBy(*keys, "color").agg(
        F.count("*").alias("n"), F.min("span_no").alias("first"), F.max("size").alias("size"), F.collect_list(F.struct("span_no", "text")).alias("parts"),
        F.min("box.x0").alias("x0"), F.min("box.y0").alias("y0"), F.max("box.x1").alias("x1"), F.max("box.y1").alias("y1"),
    )
    whole = F.array_join(F.transform(F.sort_array(F.flatten(F.collect_list("parts"))), lambda p: p["text"]), "")
    return per.groupBy(*keys).agg(
        F.regexp_replace(whole, r"^\s+|\s+$", "").alias("text"),
        rect.rect(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).alias("box"),
        F.max_by("color", F.struct(F.col("n"), -F.col("first"))).alias("color"),
        F.max("size").alias("font_size"),
    )


def small_drawings(drawings: DataFrame, dashes: Sequence[str] = ROUTE_DASHES) -> DataFrame:
    """Drawings (box, width, dash, ...) whose sides are both over 0.3 and at most 28, with their centre and ``route_like``."""
    wide, high = F.col("box.x1") - F.col("box.x0"), F.col("box.y1") - F.col("box.y0")
    low, top = SMALL_SIDES
    d = drawings.where((wide > low) & (high > low) & (wide <= top) & (high <= top))
    like = (F.coalesce("width", F.lit(0.0)) >= 1.0) & F.trim(F.coalesce("dash", F.lit(""))).isin(*dashes)
    return d.withColumn("x", (F.col("box.x0") + F.col("box.x1")) / 2).withColumn("y", (F.col("box.y0") + F.col("box.y1")) / 2).withColumn("route_like", like)


def brightness(c: Column) -> Column:
    """Mean component; 1 without a colour."""
    return F.coalesce((c[0] + c[1] + c[2]) / 3, F.lit(1.0))


def redness(c: Column) -> Column:
    """Red above the mean of green and blue; 0 without a colour."""
    return F.coalesce(c[0] - (c[1] + c[2]) / 2, F.lit(0.0))


def marker_points(kind: Column, box: Column, fill: Column, stroke: Column, items: Column, route_like: Column) -> list[Column]:
    """What a small drawing scores as a marker whatever its distance: the terms in order, the last to be taken off."""
    wide, high = box["x1"] - box["x0"], box["y1"] - box["y0"]
    given = lambda test, points: F.when(test, points).otherwise(0.0)
    return [
        F.when(kind.isin("f", "fs"), 1.1).when(kind == "s", 0.2).otherwise(0.0),
        F.when(wide.between(1.5, 12.0) & high.between(1.5, 12.0), 1.0).when((wide <= 18.0) & (high <= 18.0), 0.4).otherwise(0.0),
        given(F.least(brightness(fill), brightness(stroke)) < 0.45, 1.1),
        given((redness(fill) > 0.25) | (redness(stroke) > 0.25), 0.5),
        given(items.between(2, 80), 0.3),
        given(route_like, 2.2),
    ]


def snap_to_markers(labels: DataFrame, markers: DataFrame) -> DataFrame:
    """Every label (label, page, x, y) with the cluster of drawings around its best marker.

    Markers: (marker, page, x, y, box, kind, fill, stroke, items, route_like).  Of the
    markers within 42 points the best score counts, then the least id; the cluster are
    those within 8 points of it whose score is at most 1.25 lower.  A label without a
    marker, or with a score below 1.25, keeps its own place.  The score is
    (40 - distance) / 10, 0 at least, and the terms of ``marker_points``.  Labels meet
    the markers of their tile and what is 42 around it, as arrays.
    """
    a = labels.select("label", F.col("page").alias("_page"), F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y"))
    terms = marker_points(*[F.col(c) for c in ("kind", "box", "fill", "stroke", "items", "route_like")])
    count_of_terms = len(terms)
    b = markers.where("page is not null and x is not null and y is not null")
    b = b.select("marker", F.col("page").alias("_page"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "box", *[t.cast("double").alias(f"_s{k}") for k, t in enumerate(terms)])
    names = ("best", "cx", "cy", "cluster", "x0", "y0", "x1", "y1")
    schema = StructType([*a.schema.fields, *[StructField(c, DoubleType()) for c in names]])

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        n = a.num_rows
        out = {c: np.full(n, np.nan) for c in names}
        if n and b.num_rows:
            b = tiles.ordered(b, "marker")
            px, py, x, y = tiles.numbers(a, "_x"), tiles.numbers(a, "_y"), tiles.numbers(b, "x"), tiles.numbers(b, "y")
            sides = [tiles.numbers(b, f"box.{c}") for c in ("x0", "y0", "x1", "y1")]
            plus = [tiles.numbers(b, f"_s{k}") for k in range(count_of_terms)]
            for k in tiles.steps(n, b.num_rows):
                dx, dy = x - px[k, None], y - py[k, None]
                away = np.sqrt(dx * dx + dy * dy)
                score = np.maximum(0.0, 40.0 - away) / 10.0
                for term in plus[:-1]:
                    score += term
                score -= plus[-1]
                score[~(away <= MARKER_REACH)] = -np.inf
                first = score.argmax(axis=1)
                best = score[np.arange(len(first)), first]
                ok = best >= LEAST_SCORE
                rows, at = np.nonzero(ok[:, None] & (score >= np.where(ok, best, np.inf)[:, None] - SCORE_WINDOW))
                ux, uy = x[at] - x[first[rows]], y[at] - y[first[rows]]
                held = np.sqrt(ux * ux + uy * uy) <= CLUSTER_REACH
                rows, at = rows[held], at[held]
                out["best"][k] = np.where(np.isfinite(best), best, np.nan)
                if not len(rows):
                    continue
                whose, begin, count = np.unique(rows, return_index=True, return_counts=True)
                whose = whose + k.start
                out["cluster"][whose] = count
                out["cx"][whose], out["cy"][whose] = np.add.reduceat(x[at], begin) / count, np.add.reduceat(y[at], begin) / count
                for c, side, low in zip(("x0", "y0", "x1", "y1"), sides, (True, True, False, False), strict=True):
                    out[c][whose] = (np.fmin if low else np.fmax).reduceat(side[at], begin)
        t = a.select(["label", "_page", "_x", "_y"])
        for c in names:
            t = t.append_column(c, pa.array(out[c], from_pandas=True))
        return t

    spot = rect.rect(F.col("x"), F.col("y"), F.col("x"), F.col("y"))
    spread = tiles.covering(b.withColumn("_spot", spot), F.col("_spot"), MARKER_REACH, MARKER_REACH).drop("_spot")
    d = tiles.by_tile(tiles.placed(a, F.col("_x"), F.col("_y"), MARKER_REACH), spread, ["_page"], work, schema)
    x, y = F.coalesce("cx", "_x"), F.coalesce("cy", "_y")
    reason = F.when(F.col("best").isNull(), "marker_not_found").when(F.col("cluster").isNull(), "marker_score_low").otherwise("marker_snapped")
    box = F.when(F.col("cluster").isNotNull(), rect.rect(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    return d.select(
        "label", F.col("cluster").isNotNull().alias("marker_found"), x.alias("x"), y.alias("y"), box.alias("marker_box"),
        F.round(F.hypot(x - F.col("_x"), y - F.col("_y")), 3).alias("snap_distance"), F.round(F.coalesce("best", F.lit(0.0)), 3).alias("score"),
        F.coalesce(F.col("cluster").cast("long"), F.lit(0)).alias("cluster"), reason.alias("reason"),
    )


def best_partners(names: DataFrame, others: DataFrame, keys: Sequence[str], reach: float, score, columns: Sequence[str]) -> DataFrame:
    """(name, other, score): of the others of equal ``keys`` within ``reach`` of a name the one of the highest score, then the least label.

    Both: (label, x, y, keys, columns); keys may be null, and then equal.  ``score(away, high,
    a, b)`` gets distances, differences in y and the columns as numbers, by name and by
    other; it gives scores, negative infinity for none.  Tiles are three times as wide as
    the reach, so that an other goes to few of them; within a tile names go along x.
    """
    names, others = (d.select("label", *keys, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *columns).where("x is not null and y is not null") for d in (names, others))
    kind = names.schema["label"].dataType
    schema = StructType([StructField("name", kind), StructField("other", others.schema["label"].dataType), StructField("score", DoubleType())])
    fields = list(columns)

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        n = a.num_rows
        best, top = np.full(n, -1), np.full(n, -np.inf)
        if n and b.num_rows:
            b = tiles.ordered(b, "label")
            p, q = ({c: tiles.numbers(t, c) for c in ("x", "y", *fields)} for t in (a, b))
            by_x = np.argsort(p["x"], kind="stable")
            for part in tiles.steps(n, b.num_rows):
                k = by_x[part]
                # others that are near enough by x alone, still in order of their labels
                near = np.flatnonzero((np.fmin.reduce(p["x"][k]) - q["x"] <= reach) & (np.fmax.reduce(p["x"][k]) - q["x"] >= -reach))
                if not len(near):
                    continue
                other = {c: v[near] for c, v in q.items()}
                dx, dy = p["x"][k, None] - other["x"], p["y"][k, None] - other["y"]
                away = np.sqrt(dx * dx + dy * dy)
                s = score(away, dy, {c: p[c][k, None] for c in fields}, other)
                s[~(away <= reach)] = -np.inf
                first = s.argmax(axis=1)
                top[k] = s[np.arange(len(first)), first]
                best[k] = near[first]
        kept = np.isfinite(top)
        picked = pa.array(np.flatnonzero(kept))
        return pa.table({"name": a["label"].take(picked), "other": tiles.taken(b["label"], best[kept]), "score": pa.array(top[kept])})

    spot = rect.rect(F.col("x"), F.col("y"), F.col("x"), F.col("y"))
    tile = 3 * reach
    spread = tiles.covering(others.withColumn("_spot", spot), F.col("_spot"), tile, reach).drop("_spot")
    return tiles.by_tile(tiles.placed(names, F.col("x"), F.col("y"), tile), spread, keys, work, schema)


def reading_of(names: DataFrame, readings: DataFrame) -> DataFrame:
    """(name, reading, score): the reading label that goes with each name label, if one scores over 0.7.

    Both: (label, page, frame, x, y, color, size).  Labels belong to one page and frame and lie within 26 points.
    """

    def score(away, high, a, b):
        s = np.maximum(0.0, 24.0 - away) / 10.0 + np.where(a["_color"] == b["_color"], 1.0, 0.0) + np.where(b["size"] < a["size"], 0.3, 0.0)
        return np.where(a["_own"] == b["_own"], -np.inf, s)

    coded = lambda d: d.where("page is not null").withColumn("_color", _code("color")).withColumn("_own", _code("label"))
    d = best_partners(coded(names), coded(readings), ["page", "frame"], READING_REACH, score, ["_color", "size", "_own"])
    return d.select("name", F.col("other").alias("reading"), "score").where(F.col("score") > READING_SCORE)


def _code(column: str) -> Column:
    """A number for a value, whatever its type; null without one.  53 bits of a hash, so that a double holds it."""
    return F.when(F.col(column).isNotNull(), F.shiftrightunsigned(F.xxhash64(F.col(column).cast("string")), 11))


def gazetteer_matches(labels: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Every label (label, group, no, name) with its entry, whether an alias is the name, and how alike they are.

    Gazetteer: (entry, group, no, aliases).  The entry is that of the same group and
    number; likeness is 1 for an alias, else the best ratio over the aliases, 0 without a name or entry.
    """
    d = labels.join(gazetteer, ["group", "no"], "left").withColumn("_plain", text.normalized(F.coalesce("name", F.lit(""))))
    d = d.withColumn("exact", F.coalesce(F.array_contains("aliases", F.col("_plain")) & (F.col("name") != ""), F.lit(False)))
    rest = d.where(~F.col("exact") & F.col("entry").isNotNull() & (F.coalesce("name", F.lit("")) != ""))
    ratio = rest.select("label", "_plain", F.explode("aliases").alias("alias")).withColumn("ratio", text.sequence_ratio("_plain", "alias"))
    best = ratio.groupBy("label").agg(F.max("ratio").alias("best"))
    likeness = F.when(F.col("exact"), 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return d.join(best, "label", "left").select("label", "group", "no", "entry", "exact", likeness.alias("likeness"))
