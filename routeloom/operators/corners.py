"""Panels with four known corners: projective transform, coordinate spaces, pixel mapping, model choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Region of plausible results; slack of the coordinate-space tests.
LON_RANGE, LAT_RANGE = (132.0, 135.5), (32.5, 34.8)
PIXEL_SLACK, LEAST_SLACK, SLACK_SHARE, NEIGHBOUR_SHARE = 8.0, 6.0, 0.02, 0.75


def projective(box: Column, top_left: Column, top_right: Column, bottom_right: Column, bottom_left: Column, x: Column, y: Column) -> Column:
    """STRUCT<x, y>: where a point of ``box`` lies in the quadrangle of its corners; null at a zero denominator.

    The four pairs of corners fix the transform, so it has a closed form from the unit square.
    """
    u = (x - box["x0"]) / (box["x1"] - box["x0"])
    v = (y - box["y0"]) / (box["y1"] - box["y0"])
    p = (top_left, top_right, bottom_right, bottom_left)
    away = lambda c: (p[1][c] - p[2][c], p[3][c] - p[2][c], p[0][c] - p[1][c] + p[2][c] - p[3][c])
    (ax, bx, sx), (ay, by, sy) = away("x"), away("y")
    den = ax * by - bx * ay
    g, h = F.try_divide(sx * by - bx * sy, den), F.try_divide(ax * sy - sx * ay, den)
    w = g * u + h * v + 1.0
    held = F.when(F.abs(w) >= 1e-12, w)
    place = lambda c: ((p[1][c] - p[0][c] + g * p[1][c]) * u + (p[3][c] - p[0][c] + h * p[3][c]) * v + p[0][c]) / held
    out = F.struct(place("x").alias("x"), place("y").alias("y"))
    return F.when(held.isNotNull(), out)


def transform_lines(lines: Column, box: Column, corners: Column) -> Column:
    """STRUCT<lines, issues>: lines (arrays of points) through a panel's corners, rounded to seven places.

    Points without a finite place go, lines of fewer than two points too; ``corners``
    has top_left, top_right, bottom_right and bottom_left.
    """
    at = lambda p: projective(box, corners["top_left"], corners["top_right"], corners["bottom_right"], corners["bottom_left"], p["x"], p["y"])
    finite = lambda p: p.isNotNull() & F.coalesce(~F.isnan(p["x"]) & ~F.isnan(p["y"]) & (F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")), F.lit(False))
    moved = F.transform(lines, lambda line: F.transform(line, at))
    inside = lambda p: p["x"].between(*LON_RANGE) & p["y"].between(*LAT_RANGE)

    def judged(raw: Column) -> Column:
        good = F.transform(raw, lambda line: F.filter(line, finite))
        left = F.filter(good, lambda line: F.size(line) >= 2)
        issues = F.array_compact(
            F.array(
                F.when(F.exists(raw, lambda line: F.exists(line, lambda p: ~finite(p))), "nonfinite_coordinate"),
                F.when(F.exists(good, lambda line: F.exists(line, lambda p: ~inside(p))), "out_of_shikoku_bounds"),
                F.when(F.size(left) == 0, "too_few_points"),
            )
        )
        rounded = F.transform(left, lambda line: F.transform(line, lambda p: F.struct(F.round(p["x"], 7).alias("x"), F.round(p["y"], 7).alias("y"))))
        return F.struct(rounded.alias("lines"), issues.alias("issues"))

    return F.element_at(F.transform(F.array(moved), judged), 1)


def panel_box(first: Column, second: Column, third: Column, csv_text: Column) -> Column:
    """The box of a panel: the first of three that is given, else the text 'x0;y0;x1;y1'."""
    from routeloom.functions.text import rect_text

    return F.coalesce(first, second, third, rect_text(csv_text))


def coordinate_space(bounds: Column, panel: Column, image_w: Column, image_h: Column) -> Column:
    """Which space route coordinates with these ``bounds`` are in: page_pdf_pt, panel_local_pt, image_px or unknown."""
    wide = F.greatest(F.lit(1e-6), panel["x1"] - panel["x0"])
    high = F.greatest(F.lit(1e-6), panel["y1"] - panel["y0"])
    slack = F.greatest(F.lit(LEAST_SLACK), F.least(wide, high) * SLACK_SHARE)

    def within(x0, y0, x1, y1, dx, dy) -> Column:
        return (bounds["x0"] >= x0 - dx) & (bounds["x1"] <= x1 + dx) & (bounds["y0"] >= y0 - dy) & (bounds["y1"] <= y1 + dy)

    zero = F.lit(0.0)
    page = within(panel["x0"], panel["y0"], panel["x1"], panel["y1"], slack, slack) | within(panel["x0"], panel["y0"], panel["x1"], panel["y1"], wide * NEIGHBOUR_SHARE, high * NEIGHBOUR_SHARE)
    local = within(zero, zero, wide, high, slack, slack)
    pixels = within(zero, zero, F.greatest(F.lit(1), image_w), F.greatest(F.lit(1), image_h), F.lit(PIXEL_SLACK), F.lit(PIXEL_SLACK))
    return F.when(bounds.isNull(), "unknown").when(page, "page_pdf_pt").when(local, "panel_local_pt").when(pixels, "image_px").otherwise("unknown")


def to_pixels(space: Column, x: Column, y: Column, panel: Column, image_w: Column, image_h: Column) -> Column:
    """STRUCT<x, y> in image pixels of a point in any of the spaces; unknown counts as page points."""
    sx, sy = image_w / (panel["x1"] - panel["x0"]), image_h / (panel["y1"] - panel["y0"])
    px = F.when(space == "image_px", x).when(space == "panel_local_pt", x * sx).otherwise((x - panel["x0"]) * sx)
    py = F.when(space == "image_px", y).when(space == "panel_local_pt", y * sy).otherwise((y - panel["y0"]) * sy)
    return F.struct(px.alias("x"), py.alias("y"))


def active_model(asked: Column, has_affine: Column, has_projective: Column, pairs: Column) -> Column:
    """The model that a panel's preview uses: as asked for where it exists, else the next simpler one."""
    affine = F.when(has_affine, "affine").otherwise("similarity")
    return (
        F.when(asked == "similarity", "similarity").when(asked == "affine", affine).when(asked == "projective", F.when(has_projective, "projective").otherwise(affine))
        .when(pairs <= 2, "similarity").otherwise(affine)
    )


def preview_warnings(model: Column, pairs: Column, rmse: Column) -> Column:
    """Warnings of a preview: a projective fit of four pairs has no error to judge it by."""
    return F.array_compact(F.array(F.when((model == "projective") & (pairs == 4) & (rmse < 1e-6), "four_point_projective_has_no_residual"), F.when(pairs < 2, "too_few_pairs")))


def ranked_residuals(rows: DataFrame, keys: list[str], error: str, tie: str) -> DataFrame:
    """``place`` of each control point of its key, the largest residual first."""
    from pyspark.sql import Window

    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(error), tie)))
