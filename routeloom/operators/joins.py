"""Joins that need more than equal keys: containment, nearest rectangle, nearest segment."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from routeloom.functions import rect
from routeloom.operators import tiles
from routeloom.session import ship, written


def best_per(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in ``order``."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def assign_container(items: DataFrame, frames: DataFrame, reach: float = 24.0, cell: float = 256.0) -> DataFrame:
    """Each item (item_id, page, box) with the frame that holds its centre, else the nearest within ``reach``.

    Frames: (frame_id, frame_page, frame_box, score).  Of the frames that hold the centre
    the least area wins, then the highest score; else the least distance between the
    boxes, then the area.  Items without a frame stay, with nulls.  Items go to the tile
    of their centre and frames to all that they can reach; a tile is worked off as arrays.
    Items larger than a tile meet the frames in grid cells of the size ``cell``.
    """
    b = F.col("box")
    tile = max(reach, min(cell, tiles.mean_side(frames, F.col("frame_box"))))
    wide = F.coalesce(F.greatest(F.abs(b["x1"] - b["x0"]), F.abs(b["y1"] - b["y0"])) > tile, F.lit(False))
    return _contained(items.where(~wide), frames, reach, tile).unionByName(_contained_by_cells(items.where(wide), frames, reach, cell))


def _contained(items: DataFrame, frames: DataFrame, reach: float, tile: float) -> DataFrame:
    """``assign_container`` of items whose sides are at most ``tile``."""
    b = F.col("box")
    left = tiles.placed(items, (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2, tile).withColumn("frame_page", F.col("page"))
    right = tiles.covering(frames.select("frame_id", "frame_page", "frame_box", "score").where("frame_page is not null"), F.col("frame_box"), tile, reach + tile / 2)
    schema = StructType([*items.schema.fields, StructField("frame_id", frames.schema["frame_id"].dataType), StructField("gap", DoubleType())])
    names = items.columns

    def work(a: pa.Table, f: pa.Table) -> pa.Table:
        n = a.num_rows
        best, gap = np.full(n, -1), np.full(n, np.nan)
        if n and f.num_rows:
            f = f.append_column("_area", pa.array(_area(f, "frame_box")))
            f = tiles.ordered(f, "_area", "frame_id")
            worth = tiles.ordered(f.append_column("_at", pa.array(np.arange(f.num_rows))), "_area", "-score", "frame_id")["_at"].to_numpy()
            u, v, x, y = (tiles.numbers(f, f"frame_box.{k}") for k in ("x0", "x1", "y0", "y1"))
            p, q, r, s = (tiles.numbers(a, f"box.{k}") for k in ("x0", "x1", "y0", "y1"))
            cx, cy = (p + q) / 2, (r + s) / 2
            # only frames that reach the centres of this tile can hold one
            able = worth[(u[worth] <= cx.max()) & (v[worth] >= cx.min()) & (x[worth] <= cy.max()) & (y[worth] >= cy.min())] if not np.isnan(cx).any() else worth
            for k in tiles.steps(n, len(able)):
                if len(able):
                    m = (cx[k, None] >= u[able]) & (cx[k, None] <= v[able]) & (cy[k, None] >= x[able]) & (cy[k, None] <= y[able])
                    first = m.argmax(axis=1)
                    hit = m[np.arange(len(first)), first]
                    best[k], gap[k] = np.where(hit, able[first], -1), np.where(hit, 0.0, np.nan)
            free = np.flatnonzero(best < 0)
            for k in tiles.steps(len(free), f.num_rows):
                i = free[k]
                dx = np.maximum(0.0, np.maximum(u - q[i, None], p[i, None] - v))
                dy = np.maximum(0.0, np.maximum(x - s[i, None], r[i, None] - y))
                away = np.sqrt(dx * dx + dy * dy)
                away[np.isnan(away)] = np.inf
                first = away.argmin(axis=1)
                least = away[np.arange(len(first)), first]
                best[i], gap[i] = np.where(least <= reach, first, -1), np.where(least <= reach, least, np.nan)
        out = a.select(names).append_column("frame_id", tiles.taken(f["frame_id"], best))
        return out.append_column("gap", pa.array(gap, mask=best < 0))

    return tiles.by_tile(left, right, ["frame_page"], work, schema)


def _area(t: pa.Table, box: str) -> np.ndarray:
    x0, y0, x1, y1 = (tiles.numbers(t, f"{box}.{k}") for k in ("x0", "y0", "x1", "y1"))
    return np.maximum(0.0, x1 - x0) * np.maximum(0.0, y1 - y0)


def _contained_by_cells(items: DataFrame, frames: DataFrame, reach: float, cell: float) -> DataFrame:
    """``assign_container`` of large items, which go to all cells that they cover."""
    b = F.col("box")
    look = tiles.covering(items.withColumnRenamed("page", "frame_page"), b, cell)
    met = look.join(tiles.covering(frames, F.col("frame_box"), cell, reach), ["frame_page", "_cx", "_cy"])
    held = rect.holds_point(F.col("frame_box"), (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2)
    gap = F.when(held, F.lit(-1.0)).otherwise(rect.gap(b, F.col("frame_box")))
    near = met.withColumn("gap", gap).where(F.col("gap") <= reach).withColumn("box_area", rect.area(F.col("frame_box")))
    order = [F.col("gap"), F.col("box_area"), F.when(F.col("gap") < 0, -F.col("score")), F.col("frame_id")]
    best = best_per(near, ["item_id"], *order).select("item_id", "frame_id", F.greatest("gap", F.lit(0.0)).alias("gap"))
    return items.join(best, "item_id", "left").select(*items.columns, "frame_id", "gap")


def parallel_lines(segments: DataFrame) -> DataFrame:
    """(a, b): long flat auxiliary segments of a page that run beside each other.

    Segments: (id, page, box, length, style).  Both are walk_sub, at least 250 long and at
    most 20 high; they share 70 % of the lesser width and their middles are at most 4 apart in height.
    Only lines of neighbouring bands of height meet.
    """
    band = F.floor((F.col("box.y0") + F.col("box.y1")) / 8).cast("long")
    able = segments.where("style = 'walk_sub' and length >= 250 and box.y1 - box.y0 <= 20").select("id", "page", "box", band.alias("band"))
    a = able.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))).alias("a")
    b = able.alias("b")
    wide = F.greatest(F.lit(0.0), F.least("a.box.x1", "b.box.x1") - F.greatest("a.box.x0", "b.box.x0"))
    least = F.least(F.col("a.box.x1") - F.col("a.box.x0"), F.col("b.box.x1") - F.col("b.box.x0"))
    level = F.abs((F.col("a.box.y0") + F.col("a.box.y1")) / 2 - (F.col("b.box.y0") + F.col("b.box.y1")) / 2)
    met = a.join(b, (F.col("a.page") == F.col("b.page")) & (F.col("a.band") == F.col("b.band")) & (F.col("a.id") < F.col("b.id")))
    return met.where((wide >= least * 0.7) & (level <= 4)).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def rect_pairs(left: DataFrame, limit: float) -> DataFrame:
    """(a, b, page, iou, overlap): rectangles (id, page, box) of a page whose gap is at most ``limit``, a < b; overlap is the share of a that lies in b.

    They go to all tiles that they cover; a pair comes from the one that has the low
    corner of what a, widened by the limit, and b share.
    """
    box, wide = F.col("box"), limit * (1 + 1e-9) + 1e-9
    tile = tiles.mean_side(left, box) + limit
    d = left.select("id", "page", "box").where("page is not null")
    kind = d.schema["id"].dataType
    schema = StructType([StructField("a", kind), StructField("b", kind), d.schema["page"], StructField("iou", DoubleType()), StructField("overlap", DoubleType())])
    sides = ("x0", "y0", "x1", "y1")

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return pa.table({f.name: pa.array([], t.type) for f, t in zip(schema.fields, to_arrow_schema(schema), strict=True)})
        cx, cy = a["_cx"][0].as_py(), a["_cy"][0].as_py()
        p, q = ([tiles.numbers(t, f"box.{c}") for c in sides] for t in (a, b))
        ids, others = a["id"].to_numpy(), b["id"].to_numpy()
        west, north = (np.minimum(p[c], p[c + 2]) - wide for c in (0, 1))
        left_of, top_of = np.minimum(q[0], q[2]), np.minimum(q[1], q[3])
        rows, at = [], []
        for k in tiles.steps(a.num_rows, b.num_rows):
            x0, y0, x1, y1 = (v[k, None] for v in p)
            dx = np.maximum(0.0, np.maximum(x0 - q[2], q[0] - x1))
            dy = np.maximum(0.0, np.maximum(y0 - q[3], q[1] - y1))
            near = (ids[k, None] < others) & (np.sqrt(dx * dx + dy * dy) <= limit)
            i, n = np.nonzero(near)
            i += k.start
            here = (np.floor(np.maximum(west[i], left_of[n]) / tile) == cx) & (np.floor(np.maximum(north[i], top_of[n]) / tile) == cy)
            rows.append(i[here])
            at.append(n[here])
        i, n = np.concatenate(rows), np.concatenate(at)
        share = lambda u, v: np.maximum(0.0, np.minimum(p[v][i], q[v][n]) - np.maximum(p[u][i], q[u][n]))
        both, own, other = share(0, 2) * share(1, 3), _area(a, "box")[i], _area(b, "box")[n]
        whole = own + other - both
        iou = np.divide(both, whole, out=np.zeros(len(both)), where=whole != 0)
        picked = pa.array(i)
        return pa.table({"a": a["id"].take(picked), "b": b["id"].take(pa.array(n)), "page": a["page"].take(picked), "iou": iou, "overlap": both / np.maximum(own, 1e-6)})

    return tiles.by_tile(tiles.covering(d, box, tile, wide), tiles.covering(d.select("id", F.col("page").alias("page"), "box"), box, tile), ["page"], work, schema)


def best_overlap(small: DataFrame, large: DataFrame, least: float) -> DataFrame:
    """(label, id, share): of the large boxes (id, page, box) of its page the one that has most of a small one (label, page, box), if it has ``least``; of equals the least id."""
    b = F.col("box")
    half = small.agg(F.max(F.greatest(F.abs(b["x1"] - b["x0"]), F.abs(b["y1"] - b["y0"]))).alias("m")).first()["m"] or 0.0
    tile = max(half, tiles.mean_side(large, b))
    schema = StructType([small.schema["label"], large.schema["id"], StructField("share", DoubleType())])

    def work(a: pa.Table, f: pa.Table) -> pa.Table:
        best, top = np.full(a.num_rows, -1), np.full(a.num_rows, np.nan)
        if a.num_rows and f.num_rows:
            f = tiles.ordered(f, "id")
            p, q = ([tiles.numbers(t, f"box.{c}") for c in ("x0", "y0", "x1", "y1")] for t in (a, f))
            own = np.maximum(_area(a, "box"), 1e-6)
            for k in tiles.steps(a.num_rows, f.num_rows):
                x0, y0, x1, y1 = (v[k, None] for v in p)
                share = np.maximum(0.0, np.minimum(x1, q[2]) - np.maximum(x0, q[0])) * np.maximum(0.0, np.minimum(y1, q[3]) - np.maximum(y0, q[1])) / own[k, None]
                share[np.isnan(share)] = -1.0
                best[k] = share.argmax(axis=1)
                top[k] = share.max(axis=1)
        kept = np.flatnonzero(top >= least)
        return pa.table({"label": a["label"].take(pa.array(kept)), "id": tiles.taken(f["id"], best[kept]), "share": pa.array(top[kept])})

    left = tiles.placed(small.where("page is not null"), (b["x0"] + b["x1"]) / 2, (b["y0"] + b["y1"]) / 2, tile)
    return tiles.by_tile(left, tiles.covering(large.select("id", F.col("page").alias("page"), "box"), b, tile, half / 2 + 1e-6), ["page"], work, schema)


def nearest_segment(points: DataFrame, segments: DataFrame, cell: float, columns: Sequence[str] = ("point_id", "segment_id", "t", "distance")) -> DataFrame:
    """Each point (x, y) with the nearest of segments (segment_id, ax, ay, bx, by), however far.

    ``columns`` come back, of those of the point, of its segment, the share ``t`` of the
    segment at the nearest place, and ``distance``; all are null without a segment but the
    point's.  What goes along here need not be joined to the points again.

    Points are dealt into tiles, and a segment goes to all tiles within ``width`` of its
    box, which is right for anything within ``width``; a tile is worked off as arrays.
    The first width follows the number of segments on the area, ``cell`` at most.  Points
    that found nothing so near look again at eight times the width.  What a level found
    and left is written, so no level computes the ones before again.  Ties go to the lesser segment id.
    """
    along = [c for c in columns if c not in points.columns and c not in ("t", "distance")]
    s = segments.select(*dict.fromkeys(["segment_id", "ax", "ay", "bx", "by", *along])).withColumn("box", rect.rect(F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"), F.greatest("ay", "by")))
    x0, y0, x1, y1 = (F.col(f"box.{k}") for k in ("x0", "y0", "x1", "y1"))
    row = s.agg(
        F.max(F.greatest(F.abs(x0), F.abs(x1), F.abs(y0), F.abs(y1))).alias("ends"), F.count("*").alias("n"), ((F.max(x1) - F.min(x0)) * (F.max(y1) - F.min(y0))).alias("area"), F.avg(F.greatest(x1 - x0, y1 - y0)).alias("side")
    ).first()
    measured = [c for c in ("t", "distance") if c in columns or c == "distance"]
    found = StructType([*points.schema.fields, *[StructField(c, segments.schema[c].dataType) for c in along], *[StructField(c, DoubleType()) for c in measured]])
    if row["ends"] is None:
        return points.sparkSession.createDataFrame([], found).select(*columns)
    reach = points.agg(F.max(F.greatest(F.abs("x"), F.abs("y"))).alias("s")).first()["s"] or 0.0
    names = points.columns

    def work(a: pa.Table, b: pa.Table) -> pa.Table:
        n = a.num_rows
        best, share, away = np.full(n, -1), np.full(n, np.nan), np.full(n, np.nan)
        if n and b.num_rows:
            b = tiles.ordered(b, "segment_id")
            ax, ay, bx, by = (tiles.numbers(b, c) for c in ("ax", "ay", "bx", "by"))
            dx, dy = bx - ax, by - ay
            square = dx * dx + dy * dy
            length = np.where(square <= 1e-12, np.inf, square)  # a point where it has no length
            x, y = tiles.numbers(a, "x"), tiles.numbers(a, "y")
            for k in tiles.steps(n, b.num_rows):
                px, py = x[k, None] - ax, y[k, None] - ay
                t = np.maximum(0.0, np.minimum(1.0, (px * dx + py * dy) / length))
                u, v = px - t * dx, py - t * dy
                d = np.sqrt(u * u + v * v)
                d[np.isnan(d)] = np.inf
                first = d.argmin(axis=1)
                at = np.arange(len(first)), first
                known = np.isfinite(d[at])
                best[k], share[k], away[k] = np.where(known, first, -1), t[at], d[at]
        out = a.select(names)
        for c in along:
            out = out.append_column(c, tiles.taken(b[c], best))
        for c in measured:
            out = out.append_column(c, pa.array({"t": share, "distance": away}[c], mask=best < 0))
        return out

    done: list[DataFrame] = []
    left, width = points, max(float(np.sqrt(2 * (row["area"] or 0.0) / row["n"])), (row["side"] or 0.0) / 4)
    width = min(float(cell), width) if width > 0 else float(cell)
    while True:
        last = width > 2 * (row["ends"] + reach)
        spread = tiles.covering(s, F.col("box"), 2 * width, width)
        met = tiles.by_tile(tiles.placed(left, F.col("x"), F.col("y"), 2 * width), spread, [], work, found)
        level = written(met, "nearest")
        near = F.coalesce(F.col("distance") <= width, F.lit(False)) if not last else F.lit(True)
        done.append(level.where(near).select(*columns))
        if last:
            break
        left = level.where(~near).select(*names)
        if left.isEmpty():
            break
        width *= 8
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def points_inside(frames: DataFrame, points: DataFrame) -> DataFrame:
    """(id, n): how many points (page, x, y) the boxes of frames (id, page, box) hold, borders included; frames without any go.

    Points of a page are counted by rank, not met one by one.
    """
    return _counted(frames.select("page", "id", "box"), points, "n").groupBy("id").agg(F.sum("n").alias("n")).where("n > 0")


def with_points_inside(frames: DataFrame, points: DataFrame, name: str) -> DataFrame:
    """All frames (id, page, box, ...) with how many points their id holds as ``name``, as by ``points_inside``, and no box; nothing is joined."""
    d = _counted(frames, points, name)
    return d.withColumn(name, F.sum(name).over(Window.partitionBy("id")))


def _counted(frames: DataFrame, points: DataFrame, name: str) -> DataFrame:
    """Frames (page, box, ...) with a column ``name``, the number of points of their page in the box, instead of the box."""
    ship(frames.sparkSession)
    kept = [c for c in frames.columns if c != "box"]
    schema = StructType([*[frames.schema[c] for c in kept], StructField(name, LongType())])

    def page(a: pa.Table, b: pa.Table) -> pa.Table:
        counts = tiles.PointCounts(tiles.numbers(b, "x"), tiles.numbers(b, "y"))
        n = counts.inside(*[tiles.numbers(a, f"box.{c}") for c in ("x0", "y0", "x1", "y1")])
        return a.select(kept).append_column(name, pa.array(n, pa.int64()))

    right = points.select(F.col("page").cast(frames.schema["page"].dataType).alias("page"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    right = right.where("page is not null and x is not null and y is not null")
    return frames.groupBy("page").cogroup(right.groupBy("page")).applyInArrow(page, schema)


def merge_preferred(automatic: DataFrame, manual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Automatic rows of groups without manual ones, and all manual rows."""
    return automatic.join(manual.select(*keys).distinct(), list(keys), "left_anti").unionByName(manual, allowMissingColumns=True)
