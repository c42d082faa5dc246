"""Ordered rule cascades and additive scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routeloom.functions import color

ROUTE_CLASS = "red_solid_route"


def capped(score: Column, high: float = 0.98) -> Column:
    return F.greatest(F.lit(0.0), F.least(score, F.lit(high)))


def reason_list(*rules: tuple[Column, str]) -> Column:
    """Codes of the rules that hold, in order."""
    return F.array_compact(F.array(*[F.when(test, F.lit(code)) for test, code in rules]))


def object_class(draw_type, fill_distance, dash, width, box_w, box_h, path, closed, segments) -> Column:
    """Class of a red drawing: the first rule that holds, filled shapes first."""
    perimeter = F.when((box_w > 0) & (box_h > 0), 2 * (box_w + box_h)).otherwise(0.0)
    boxed = (closed > 0) & (box_w >= 18) & (box_h >= 18) & (path <= perimeter + 12)
    middle = width.between(0.8, 2.4)
    return (
        F.when((draw_type == "fs") | fill_distance.isNotNull(), "filled_symbol_or_legend")
        .when((box_w < 14) & (box_h < 14) & (path < 40), "small_symbol_or_label")
        .when((dash != "solid") & middle & (path >= 20), "red_dashed_nonroute")
        .when(dash != "solid", "annotation_dashed")
        .when((box_w > 120) & (box_h < 40) & (path < 300), "legend_like")
        .when(boxed, "red_annotation_solid")
        .when(middle & (path >= 15) & (segments >= 1), ROUTE_CLASS)
        .when(path >= 10, "red_annotation_solid")
        .otherwise("unknown_red")
    )


def frame_score(w, h, draw_type, stroke, fill, stroke_width, routes, rect_like, complexity, page_w, page_h) -> Column:
    """Additive score of a frame candidate, with capped route terms."""
    add = lambda test, points: F.when(test, F.lit(points)).otherwise(0.0)
    density = routes / F.greatest(w * h, F.lit(1.0))
    aspect = w / F.greatest(h, F.lit(1.0))
    dark = color.dark(stroke) & (stroke_width >= 0.3)
    return (
        add(color.pale_fill(fill), 3.0)
        + F.when(dark & (stroke_width >= 1.2), 2.5).when(dark, 1.5).otherwise(0.0)
        + add(color.bluish(stroke) & (stroke_width >= 1.0), 0.8)
        + add(rect_like, 0.6)
        + add(draw_type.isin("f", "fs") & (complexity >= 6), 0.6)
        + F.least(routes, F.lit(40)) * 0.18
        + F.least(density * 120000.0, F.lit(1.6))
        + add(color.near_white(fill), -1.5)
        + add((w > page_w * 0.95) & (h > page_h * 0.4), -2.0)
        + add((aspect > 5.5) | (aspect < 0.18), -1.5)
        + add((complexity <= 2) & ~rect_like, -2.5)
        + add(routes == 0, -3.0)
    )


def segment_confidence(cls, width, length, has_frame) -> tuple[Column, Column]:
    """(confidence, reasons) of a route segment."""
    is_route = cls == ROUTE_CLASS
    score = (
        F.lit(0.58)
        + F.when(is_route, 0.16).otherwise(0.0)
        + F.when(is_route & width.between(0.9, 2.2), 0.08).otherwise(0.0)
        + F.when(length >= 40, 0.06).when(length < 10, -0.16).otherwise(0.0)
        + F.when(has_frame, 0.0).otherwise(-0.18)
    )
    return capped(score), reason_list((length < 10, "very_short_segment"), (~has_frame, "missing_frame_id"))


def component_confidence(mean, branches, chains, fallback, low, edge, duplicate) -> tuple[Column, Column]:
    """(confidence, reasons) of a merged route."""
    rules = [
        (branches > 0, "branching_component", 0.10),
        (chains > 1, "multi_chain_component", 0.07),
        (fallback, "fallback_frame", 0.08),
        (low, "contains_low_confidence_segment", 0.06),
        (edge, "frame_assignment_error", 0.12),
        (duplicate, "extra_segment", 0.10),
    ]
    score = mean
    for test, _, points in rules:
        score = score - F.when(test, points).otherwise(0.0)
    return capped(score), reason_list(*[(t, c) for t, c, _ in rules])


def quality_status(count, error, good: float = 50.0, fair: float = 150.0, least: int = 4) -> Column:
    return F.when((count < least) | error.isNull(), "fail").when(error < good, "pass").when(error <= fair, "review").otherwise("fail")


def transform_confidence(route, mean_confidence, loocv, seam, used_page) -> Column:
    """Product of a route's confidence with decays for model error, seams and page fallback."""
    fit = F.when(loocv < 50, 0.98).when(loocv <= 150, F.greatest(F.lit(0.45), 0.8 - (loocv - 50) / 250.0)).otherwise(0.2)
    edge = F.when(seam.isNull(), 1.0).otherwise(F.greatest(F.lit(0.3), 1.0 - seam / 2000.0))
    return capped(route * mean_confidence * fit * edge * F.when(used_page, 0.82).otherwise(1.0), 0.99)


def likely_issue(max_distance, snap_ratio, far, far_footpaths) -> Column:
    """``far``: distant samples with a road class; ``far_footpaths``: those of them on paths."""
    return (
        F.when(max_distance > 100, "likely_georef_misalignment")
        .when((far > 0) & (far_footpaths >= F.greatest(F.lit(1), F.floor(far / 2))), "possible_missing_trail_in_osm")
        .when(snap_ratio < 0.6, "mixed_alignment_or_missing_path")
        .otherwise("needs_manual_review")
    )


def problem_type(ok, branches, chains, style, precision, recall, iou, issue, failed, snapped, edge_shape, small) -> Column:
    """Why an extraction went wrong; ``edge_shape``: flat, wide and at the frame's lower edge."""
    side = style == "walk_sub"
    known = "correct_extraction_but_georef_or_osm_issue"
    return (
        F.when(ok, known)
        .when(branches > 0, "wrong_merge")
        .when(chains > 1, "broken_chain")
        .when(side & edge_shape, "frame_assignment_error")
        .when(side & (precision < 0.16) & (recall < 0.08), "legend_or_label_noise")
        .when((precision < 0.18) & (recall >= 0.18), "extra_segment")
        .when((recall < 0.15) & (precision >= 0.22), "missing_segment")
        .when((issue == "mixed_alignment_or_missing_path") & (snapped < 0.65), known)
        .when((issue == "likely_georef_misalignment") & (failed > 0.05), known)
        .when(side & small, "wrong_style_class")
        .when(iou < 0.08, "wrong_merge")
        .otherwise(known)
    )


def recommended_action(ok, problem, overlap, issue, p90, longest, failed, snapped, control_ok) -> Column:
    """What to do with a route, from its extraction and its fit to roads."""
    matched = (p90 < 60) & (snapped >= 0.7)
    mixed = issue == "mixed_alignment_or_missing_path"
    shifted = issue == "likely_georef_misalignment"
    bad = ~ok
    elsewhere = bad & (problem == "correct_extraction_but_georef_or_osm_issue") & (overlap >= 0.16)
    return (
        F.when(elsewhere & mixed, "osm_missing_or_trail")
        .when(elsewhere & ~shifted & matched, "map_match_candidate")
        .when(elsewhere, "manual_edit_needed")
        .when(bad & problem.isin("extra_segment", "frame_assignment_error", "legend_or_label_noise"), "manual_edit_needed")
        .when(bad, "extraction_fix_needed")
        .when(~control_ok & (longest > 80), "georef_gcp_recheck")
        .when((longest < 50) & (failed < 0.05), "accept_as_is")
        .when(issue == "possible_missing_trail_in_osm", "osm_missing_or_trail")
        .when(mixed & (snapped < 0.6), "osm_missing_or_trail")
        .when(matched, "map_match_candidate")
        .otherwise("manual_edit_needed")
    )


def adoption(mean, p90, longest, was_mean, was_p90, was_longest, moved_p95, moved_max, step_p95, step_max) -> tuple[Column, Column]:
    """(adopt, failed gates) of a snapped candidate against its original."""
    gates = [
        (mean <= was_mean * 0.7, "mean_distance_not_improved_enough"),
        (p90 <= was_p90 * 0.7, "p90_distance_not_improved_enough"),
        (longest <= F.greatest(F.lit(25.0), was_longest * 0.6), "max_distance_not_improved_enough"),
        ((moved_p95 <= 30) & (moved_max <= 40), "displacement_too_large"),
        ((step_max <= 35) & (step_p95 <= 20), "geometry_jump_detected"),
        ((mean <= 8) & (p90 <= 15) & (longest <= 25), "candidate_not_close_enough_to_road"),
    ]
    passed = gates[0][0]
    for gate, _ in gates[1:]:
        passed = passed & gate
    return passed, reason_list(*[(~g, c) for g, c in gates])


def review_priority(untransformed, total_length, longest_total, has_model, status, has_manual) -> tuple[Column, Column]:
    """(score, reasons) that order the review queue."""
    score = (
        untransformed * 12.0
        + F.when(longest_total > 0, F.try_divide(total_length, longest_total) * 25.0).otherwise(0.0)
        + F.when(has_model, 0.0).otherwise(30.0)
        + F.when(status == "fail", 25.0).when(status == "review", 15.0).otherwise(0.0)
        + F.when(has_manual, 0.0).otherwise(20.0)
    )
    reasons = F.array_compact(
        F.array(
            F.when(untransformed > 0, F.concat(F.lit("untransformed_routes="), untransformed.cast("string"))),
            F.when((longest_total > 0) & (total_length >= longest_total * 0.5), F.lit("long_total_route_length")),
            F.when(~has_model, F.lit("frame_model_missing")),
            F.when(status == "fail", F.lit("auto_gcp_fail")).when(status == "review", F.lit("auto_gcp_review")),
            F.when(~has_manual, F.lit("no_manual_gcp")),
        )
    )
    return F.round(score, 3), F.when(F.size(reasons) == 0, F.array(F.lit("low_priority"))).otherwise(reasons)


def panel_status(routes, done, reviewed) -> Column:
    return F.when(routes == 0, "empty").when(routes == done, "done").when(reviewed > 0, "reviewed").otherwise("draft")


def frame_candidates(rows: DataFrame, page_w: float, page_h: float) -> DataFrame:
    """Candidates that pass the gates, with ``source_kind``.

    Rows: (w, h, x0, y0, rect_like, complexity, routes, score, pale, dark).  A candidate is
    at least 90 by 60, touches the page, is like a rectangle or has four items, holds
    three routes and scores 3.2.  Pale ones are filled regions, else dark ones borders, else
    plain boxes, which must be like a rectangle; a region that is not like one and wider than
    0.55 of the page needs some density of routes.
    """
    c = F.col
    kind = F.when(c("pale"), "filled_region").when(c("dark"), "dark_border").otherwise("vector_bbox")
    on_page = (c("x0") + c("w") >= 0) & (c("y0") + c("h") >= 0) & (c("x0") <= page_w) & (c("y0") <= page_h)
    d = rows.where((c("w") >= 90) & (c("h") >= 60) & on_page & (c("rect_like") | (c("complexity") >= 4)) & (c("routes") >= 3) & (c("score") >= 3.2)).withColumn("source_kind", kind)
    thin = (c("source_kind") == "filled_region") & ~c("rect_like") & (c("w") > page_w * 0.55) & (c("routes") / F.greatest(c("w") * c("h"), F.lit(1.0)) < 0.00022)
    return d.where(~((c("source_kind") == "vector_bbox") & ~c("rect_like")) & ~thin)


def edge_line(style: Column, box: Column, length: Column, frame: Column) -> Column:
    """True for long auxiliary lines that run along an edge of their frame."""
    wide, high = frame["x1"] - frame["x0"], frame["y1"] - frame["y0"]
    near = lambda side: F.abs(box[side] - frame[side]) <= 12.0
    level = (length > F.greatest(F.lit(260.0), wide * 1.15)) & (box["y1"] - box["y0"] <= F.greatest(F.lit(18.0), high * 0.12)) & (near("y1") | near("y0"))
    upright = (length > F.greatest(F.lit(180.0), high * 1.7)) & (box["x1"] - box["x0"] <= F.greatest(F.lit(18.0), wide * 0.08)) & (near("x0") | near("x1"))
    return F.coalesce((style == "walk_sub") & (level | upright), F.lit(False))
