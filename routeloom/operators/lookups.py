"""Keyed lookups that must find their row, dispatch of reviewed routes, counters and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeloom.functions import text


def required_join(left: DataFrame, right: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """``left`` with the columns of ``right``; a row without a partner stops the job and names its key."""
    keyed = right.withColumn("_found", F.lit(True))
    named = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    held = F.when(F.col("_found"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"no {what} for "), named)).cast("boolean"))
    return left.join(keyed, list(keys), "left").withColumn("_found", held).where("_found").drop("_found")


def required_row(df: DataFrame, test: Column, what: str):
    """The first row that passes ``test``; raises KeyError without one."""
    row = df.where(test).first()
    if row is None:
        raise KeyError(f"no {what}")
    return row


def page_heights(rows: DataFrame) -> DataFrame:
    """(page_no, page_height): rows (page_no, page_height_pt, as text) with both given; of a repeated page the last in order of ``row_no`` where there is one."""
    good = rows.where((F.coalesce(F.trim("page_no"), F.lit("")) != "") & (F.coalesce(F.trim("page_height_pt"), F.lit("")) != ""))
    order = F.col("row_no") if "row_no" in rows.columns else F.col("page_height_pt")
    return good.groupBy(F.col("page_no").cast("int").alias("page_no")).agg(F.max_by(F.col("page_height_pt").cast("double"), order).alias("page_height"))


def enriched_automatic(gcps: DataFrame, heights: DataFrame) -> DataFrame:
    """Automatic control points with the page's height as text (empty if unknown), source and role."""
    d = gcps.join(heights, "page_no", "left")
    shown = F.when(F.col("page_height").isNull(), "").otherwise(F.format_string("%.3f", F.col("page_height")))
    return d.withColumn("page_height_pt", shown).withColumn("source", F.lit("auto")).withColumn("role", F.lit("auto_gcp")).drop("page_height")


OUTPUTS = ("original", "final", "final_matched", "candidates", "osm_missing", "manual_edit")


def dispatch_actions(rows: DataFrame) -> DataFrame:
    """(route_id, output, geometry, candidate_available, needs_manual_review, reasons): a row for each set that a route goes to.

    Rows: (route_id, action, adopt, needs_manual_review, reasons).  ``geometry`` says
    whether the original or the candidate line stands there.  Every route goes to the
    original, final and matched sets; candidates, missing roads and manual edits have sets of their own.
    """
    action, adopt = F.col("action"), F.coalesce("adopt", F.lit(False))
    candidate, manual = action == "map_match_candidate", action == "manual_edit_needed"
    base = F.when(candidate, text.add_reason(F.col("reasons"), "map_match_candidate", ",")).when(manual, text.add_reason(F.col("reasons"), "manual_edit_needed", ",")).otherwise(F.coalesce("reasons", F.lit("")))
    taken = F.when(candidate & adopt, text.add_reason(base, "matched_candidate_adopted", ",")).otherwise(base)
    review = F.coalesce("needs_manual_review", F.lit(False)) | candidate | manual
    one = lambda name, geometry, reasons, marked: F.struct(F.lit(name).alias("output"), geometry.alias("geometry"), candidate.alias("candidate_available"), marked.alias("needs_manual_review"), reasons.alias("reasons"))
    plain = F.lit("original")
    was = F.coalesce("needs_manual_review", F.lit(False))
    sets = F.array(
        one("original", plain, F.coalesce("reasons", F.lit("")), was),
        one("final", plain, base, review),
        one("final_matched", F.when(candidate & adopt, "candidate").otherwise(plain), taken, review),
        F.when(candidate, one("candidates", F.lit("candidate"), F.coalesce("reasons", F.lit("")), was)),
        F.when(action == "osm_missing_or_trail", one("osm_missing", plain, base, review)),
        F.when(manual, one("manual_edit", plain, base, review)),
    )
    return rows.select("route_id", "action", F.explode(F.array_compact(sets)).alias("s")).select("route_id", "action", "s.*")


def extraction_status(overlap: Column, precision: Column, recall: Column, iou: Column, red_ratio: Column) -> Column:
    """Whether a route's drawn line was found in the red of the page."""
    good = (overlap >= 0.24) & ((precision >= 0.20) | (recall >= 0.14) | (iou >= 0.10) | (red_ratio >= 0.55))
    return F.when(good, "extraction_ok").otherwise("extraction_issue")


def dominant(rows: DataFrame, cause: str, order: str) -> DataFrame:
    """(cause, n): the most frequent value, of equally frequent ones the first in ``order``; ``unknown`` without rows."""
    counts = rows.groupBy(cause).agg(F.count("*").alias("n"), F.min(order).alias("_first"))
    best = counts.agg(F.max_by(cause, F.struct(F.col("n"), -F.col("_first"))).alias("cause"), F.max("n").alias("n"))
    return best.select(F.coalesce("cause", F.lit("unknown")).alias("cause"), F.coalesce("n", F.lit(0)).alias("n"))


def route_ids(components: DataFrame) -> DataFrame:
    """``route_no`` and ``route_id`` of components (page_no, frame_id, component), counted by page in order of frame; those without a frame go."""
    w = Window.partitionBy("page_no").orderBy("frame_id", "component")
    d = components.where(F.coalesce(F.col("frame_id").cast("string"), F.lit("")) != "").withColumn("route_no", F.row_number().over(w))
    return d.withColumn("route_id", F.format_string("route_%03d_%04d", F.col("page_no").cast("int"), F.col("route_no")))


def preview_pages(matched: DataFrame, unmatched: DataFrame, limit: int = 12) -> DataFrame:
    """(page_no, n): the pages with most control points; a page with unmatched rows counts one more."""
    every = matched.select("page_no", F.lit(1).alias("k")).unionByName(unmatched.select("page_no").distinct().withColumn("k", F.lit(1)))
    return every.groupBy("page_no").agg(F.sum("k").alias("n")).orderBy(F.desc("n"), "page_no").limit(limit)


def style_class(cls: Column) -> Column:
    return F.when(cls == "red_solid_route", "walk_main").otherwise("unknown_red")


def untransformed(model: Column, reasons: Column) -> Column:
    """True for routes without a transform model, or with the reason that says so."""
    return (F.trim(F.coalesce(model, F.lit(""))) == "") | F.coalesce(reasons, F.lit("")).contains("route_not_transformed")


def model_label(model: Column, y_mode: Column) -> Column:
    """'model / y mode'; the model alone without a y mode, and nothing without a model."""
    m, y = F.trim(F.coalesce(model, F.lit(""))), F.trim(F.coalesce(y_mode, F.lit("")))
    return F.when((m != "") & (y != ""), F.concat(m, F.lit(" / "), y)).otherwise(m)


def quality_rank(status: Column) -> Column:
    """How bad a quality status is: fail 3, review 2, none 1, any other 0."""
    s = F.lower(F.trim(F.coalesce(status, F.lit(""))))
    return F.when(s == "fail", 3).when(s == "review", 2).when(s == "", 1).otherwise(0)


def kept(rows: DataFrame, flag: str, key: str, allowed: Sequence | None = None, limit: int = 0) -> DataFrame:
    """Rows whose text flag is true and, where a list is given, whose key is on it; the first ``limit`` by key if positive."""
    d = rows.where(text.truth(F.col(flag)))
    if allowed:
        d = d.where(F.col(key).isin(*allowed))
    return d.orderBy(key).limit(limit) if limit > 0 else d
