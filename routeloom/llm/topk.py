"""Exact top-k search by inner product with cover trees over data and queries.

Vectors become whole numbers, so every score is exact.  Equal vectors are one point
that keeps its ``k + 1`` least ids: no other can be in an answer.  Points fall into
cells around pivots and cells into blocks of bounded size; each block of data and
each group of queries becomes a cover tree.  Its levels have radii that halve: the
children of a node are its own centre and further centres, each more than the level's radius
from the others (separation), and each point goes to a child within that radius (covering); a single
point is a node of radius 0.  A pair of nodes (Q, R) can have no score above

    <cQ, cR> + rQ |cR| + rR |cQ| + rQ rR

with the true radii, so it is pruned when that is below the worst k-th score of Q's queries.
Pairs are opened best bound first, all children of Q against all children of R in one
product; pairs of single points are scores.  Each query
group first searches the block of its own cell, which gives it k-th scores; then
only (group, block) pairs whose bound reaches them are searched, and the answers of
all blocks are merged by (score, least id).

The roots of the blocks are broadcast: at most ``MOST_BLOCKS`` of them, as blocks
grow with the data beyond that; a large block is dealt into parts of ``BLOCK_POINTS``, each
a tree of its own, so a task holds no more than that.

Defined results: vectors that are null, empty, or hold a null or a component that is
not finite take no part, nor do null ids; shorter vectors count as padded with
zeros; repeated rows are candidates each by itself, and a repeated query id is one
query for each distinct vector; a query never finds a row of its own id.  Components and
scores are held within the range of a long; sums beyond 2**53 are taken in whole numbers.
In many dimensions without clusters all points lie about equally far apart: a node then has as many
children as points, and the search compares all pairs of a (group, block), block by block.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeloom.session import ship, written

PIVOTS, BLOCK_POINTS, GROUP_QUERIES, MOST_BLOCKS = 64, 2_048, 512, 16_384
_LONG = 2**63 - 1


def root_of(vectors: np.ndarray) -> tuple[int, float]:
    """(centre, covering radius): the point nearest to the mean and how far the others are."""
    centre = int(np.argmin(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1)))
    return centre, float(np.sqrt(((vectors - vectors[centre]) ** 2).sum(axis=1).max()))


class Node:
    """A cover tree node: its points, and its children's centres, radii and nodes (None for single points)."""

    __slots__ = ("centres", "kids", "lengths", "points", "radii")

    def __init__(self, points: np.ndarray):
        self.points, self.centres, self.kids = points, points[:1], [None]
        self.radii = self.lengths = np.zeros(1)


def cover_tree(vectors: np.ndarray) -> Node:
    """The tree of a block: ``len(vectors)`` squared distances each way are held while it is built."""
    norms = (vectors**2).sum(axis=1)
    square = np.maximum(norms[:, None] + norms - 2 * vectors @ vectors.T, 0.0)
    lengths = np.sqrt(norms)
    centre, radius = root_of(vectors)
    root = Node(np.arange(len(vectors)))
    todo = [(root, centre, 2.0 ** np.ceil(np.log2(max(radius, 1.0))))]
    while todo:
        node, centre, scale = todo.pop()
        points = node.points
        if len(points) == 1:
            node.lengths = lengths[points]
            continue
        centres = [centre]
        while len(centres) == 1:  # levels at which nothing parts are skipped
            scale /= 2
            free = square[centre, points] > scale * scale
            while free.any():
                centres.append(int(points[np.argmax(free)]))
                free &= square[centres[-1], points] > scale * scale
            if len(centres) == 1 and scale < 0.5:  # whole numbers are further apart: rounding hides it
                centres = points.tolist()
        owner = np.arange(len(points)) if len(centres) == len(points) else np.argmin(square[np.ix_(centres, points)], axis=0)
        if len(centres) == len(points):
            centres = points.tolist()
        order = np.argsort(owner, kind="stable")
        parts = np.split(points[order], np.cumsum(np.bincount(owner, minlength=len(centres)))[:-1])
        node.centres = np.array([c for c, p in zip(centres, parts, strict=True) if len(p)])
        parts = [p for p in parts if len(p)]
        node.kids = [Node(p) if len(p) > 1 else None for p in parts]
        # a product of two differences in place of the matrix, whose rounding could make a radius too small
        node.radii = np.array([0.0 if len(p) == 1 else float(np.sqrt(((vectors[p] - vectors[c]) ** 2).sum(axis=1).max())) for c, p in zip(node.centres, parts, strict=True)])
        node.lengths = lengths[node.centres]
        todo += [(kid, int(c), scale) for kid, c in zip(node.kids, node.centres, strict=True) if kid is not None]
    return root


def bounds(scores: np.ndarray, q_radii, q_lengths, r_radii, r_lengths) -> np.ndarray:
    """What no pair of points below the nodes can exceed, for all pairs of nodes whose centres have ``scores``."""
    return scores + np.outer(q_radii, r_lengths) + np.outer(q_lengths, r_radii) + np.outer(q_radii, r_radii)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers: floats where these are exact, else Python numbers held within a long."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(a.shape[1], 1) < 2.0**53:
        return a @ b.T
    exact = np.array([[int(x) for x in row] for row in a], object) @ np.array([[int(x) for x in row] for row in b], object).T
    return np.minimum(np.maximum(exact, -_LONG - 1), _LONG)


class Search:
    """Best scores of a group of queries over one block after the other."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, worst: np.ndarray | None = None):
        self.ids, self.queries, self.k = query_ids, queries.astype(float), k
        self.best: list[list[tuple[int, int]]] = [[] for _ in query_ids]  # heaps of (score, -id)
        self.worst = np.full(len(query_ids), -np.inf) if worst is None else worst.astype(float)
        self.tree = cover_tree(self.queries)
        self.opened = 0

    def least(self, node: Node | None, centre: int) -> float:
        """What a score must reach to be of use below a node."""
        worst = self.worst[centre] if node is None else self.worst[node.points].min()
        return worst - 1e-6 - 1e-12 * abs(worst) if np.isfinite(worst) else worst

    def over(self, tree: Node, vectors: np.ndarray, ids: list[list[int]]) -> None:
        """Search one block; ``ids``: those of each point."""
        count, heap = 0, [(-np.inf, 0, self.tree, tree)]
        while heap:
            negative, _, q, r = heapq.heappop(heap)
            if -negative < self.least(q, 0):
                continue
            self.opened += 1
            scores = products(self.queries[q.centres], vectors[r.centres])
            single_q, single_r = (np.array([kid is None for kid in n.kids]) for n in (q, r))
            if single_q.any() and single_r.any():
                self._take(q.centres[single_q], r.centres[single_r], scores[np.ix_(single_q, single_r)], ids)
            if single_q.all() and single_r.all():
                continue
            limit = bounds(scores.astype(float), q.radii, q.lengths, r.radii, r.lengths)
            wanted = np.array([self.least(kid, c) for kid, c in zip(q.kids, q.centres.tolist(), strict=True)])
            open_ = (limit >= wanted[:, None]) & ~(single_q[:, None] & single_r)
            # all single points of one side that a node of the other reaches are one pair
            for j in np.flatnonzero(~single_r & open_[single_q].any(axis=0)).tolist():
                count += 1
                some = np.flatnonzero(single_q & open_[:, j])
                heapq.heappush(heap, (-float(limit[some, j].max()), count, _part(q, some), r.kids[j]))
            for i in np.flatnonzero(~single_q & open_[:, single_r].any(axis=1)).tolist():
                count += 1
                some = np.flatnonzero(single_r & open_[i])
                heapq.heappush(heap, (-float(limit[i, some].max()), count, q.kids[i], _part(r, some)))
            for i, j in np.argwhere(open_ & ~single_q[:, None] & ~single_r).tolist():
                count += 1
                heapq.heappush(heap, (-float(limit[i, j]), count, q.kids[i], r.kids[j]))

    def _take(self, rows: np.ndarray, points: np.ndarray, scores: np.ndarray, ids: list[list[int]]) -> None:
        """Scores of single queries and points."""
        worst = self.worst[rows]
        slack = np.where(np.isfinite(worst), np.abs(np.where(np.isfinite(worst), worst, 0)) * 1e-12, 0)
        for row, i in zip(np.flatnonzero(scores.max(axis=1) >= worst - slack).tolist(), rows[scores.max(axis=1) >= worst - slack].tolist(), strict=True):
            line = scores[row]
            good = np.flatnonzero(line >= worst[row] - slack[row])
            if len(good) > 4 * self.k:  # only the best k points, and ties with the last of them, can stay
                last = np.sort(line[good])[-self.k - 1] if line.dtype == object else np.partition(line[good], -self.k - 1)[-self.k - 1]
                good = good[line[good] >= last]
            heap, own = self.best[i], int(self.ids[i])
            for c in good[np.argsort(-line[good], kind="stable")].tolist():
                score = int(line[c])
                for other in ids[points[c]]:
                    if other == own:
                        continue
                    item = (score, -other)
                    if len(heap) < self.k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
                    else:
                        break
            if len(heap) == self.k:
                self.worst[i] = max(self.worst[i], heap[0][0])


def _part(node: Node, some: np.ndarray) -> Node:
    """The node of some children, all of them single points."""
    part = Node(node.centres[some])
    part.centres, part.kids = node.centres[some], [None] * len(some)
    part.radii, part.lengths = node.radii[some], node.lengths[some]
    return part


def _vectors(column: list[bytes]) -> np.ndarray:
    width = max(map(len, column)) // 8
    out = np.zeros((len(column), width))
    for k, raw in enumerate(column):
        v = np.frombuffer(raw, "<i8")
        out[k, : len(v)] = v
    return out


def _raw(numbers: list[int]) -> bytes:
    return np.array(numbers, "<i8").tobytes()


def whole_numbers(df: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, numbers): floor(scale * x) of every usable vector."""
    x = F.col("x")
    good = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vector_col), lambda v: v.cast("double")).alias("x"))
    rows = rows.where(F.col("id").isNotNull() & x.isNotNull()).where((F.size("x") > 0) & good)
    return rows.select("id", F.transform("x", lambda v: F.floor(v * scale)).alias("numbers"))


def search(df: DataFrame, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows of every query.

    Queries: rows whose id is divisible by ``every``.  Score: inner product of the
    vectors as whole numbers, floor(``scale`` * component).  Ties go to the lesser id.
    """
    spark = df.sparkSession
    ship(spark)
    rows = whole_numbers(df, scale, id_col, vector_col)
    least = Window.partitionBy("numbers").orderBy("id")
    kept = rows.withColumn("n", F.row_number().over(least)).where(F.col("n") <= k + 1)
    points = kept.groupBy("numbers").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("point", F.xxhash64("numbers"))
    pivots = [r["numbers"] for r in points.orderBy("point", "numbers").select("numbers").limit(PIVOTS).collect()]  # where cells lie, nothing else
    schema = "query_id long, rank int, vec_id long, score long"
    if not pivots:
        return spark.createDataFrame([], schema)
    near = spark.sparkContext.broadcast(_vectors([_raw(p) for p in pivots]))

    def to_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = near.value
        for batch in batches:
            raw = [_raw(v) for v in batch.column(1).to_pylist()]
            if not raw:
                continue
            v = _vectors(raw)
            width = min(v.shape[1], centres.shape[1])
            far = (v**2).sum(axis=1)[:, None] - 2 * v[:, :width] @ centres[:, :width].T + (centres**2).sum(axis=1)
            cell = np.argmin(far, axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), batch.column(2), pa.array(cell, pa.int32())], ["point", "vector", "ids", "cell"])

    points = written(points.select("point", "numbers", "ids").mapInArrow(to_cells, "point long, vector binary, ids array<long>, cell int"), "points")
    asked = rows.where(F.col("id") % every == 0).distinct().select("id", "numbers", F.array("id").alias("ids"))
    queries = written(asked.mapInArrow(to_cells, "point long, vector binary, ids array<long>, cell int").withColumnRenamed("point", "query"), "queries")

    total = points.count()
    size = max(BLOCK_POINTS, -(-2 * total // MOST_BLOCKS))
    parts = -(-size // BLOCK_POINTS)
    points = _dealt(points, "point", size, "block").withColumn("part", F.pmod(F.xxhash64("vector", "point"), F.lit(parts)))
    queries = _dealt(queries, "query", GROUP_QUERIES, "query_group")

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block, part), found in _runs_of(batches, 2):
            v = _vectors([r[2] for r in found])
            centre, radius = root_of(v)
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([part]), pa.array([v[centre].tobytes()], pa.binary()), pa.array([radius])], ["block", "part", "centre", "radius"])

    by_part = points.select("block", "part", "vector").repartition("block", "part").sortWithinPartitions("block", "part")
    tops = by_part.mapInArrow(roots, "block long, part long, centre binary, radius double").collect()
    known = spark.sparkContext.broadcast(_Roots([(r["block"], r["part"], bytes(r["centre"]), r["radius"]) for r in tops]))  # a row of a few hundred bytes for BLOCK_POINTS points

    plan = "block long, part long, query_group long, vector binary, query long, worst double"
    names = ["block", "part", "query_group", "vector", "query", "worst"]

    def asking(found: list[tuple], group: int, at: int, worst: list[float]) -> pa.RecordBatch:
        n, roots = len(found), known.value
        return pa.RecordBatch.from_arrays(
            [pa.array([int(roots.blocks[at])] * n), pa.array([int(roots.parts[at])] * n), pa.array([group] * n), pa.array([r[1] for r in found], pa.binary()), pa.array([r[2] for r in found], pa.int64()), pa.array(worst, pa.float64())], names
        )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The block with the best bound for each query group."""
        for (group,), found in _runs_of(batches, 1):
            best = int(np.argmax(known.value.limits(_vectors([r[1] for r in found]))))
            yield asking(found, group, best, [float("-inf")] * len(found))

    by_group = queries.select("query_group", "vector", "query").repartition("query_group").sortWithinPartitions("query_group")
    first = _searched(by_group.mapInArrow(choose, plan), points, k)
    seeds = first.groupBy("query_id", "vector").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    seeds = seeds.select(F.col("query_id").alias("query"), "vector", F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(float("-inf")).alias("worst"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each query group the blocks whose bound reaches its worst k-th score."""
        for (group,), found in _runs_of(batches, 1):
            worst = [r[3] for r in found]
            least = min(worst)
            slack = 1e-6 + 1e-12 * abs(least) if np.isfinite(least) else 0.0
            for at in np.flatnonzero(known.value.limits(_vectors([r[1] for r in found])) >= least - slack).tolist():
                yield asking(found, group, at, worst)

    seeded = queries.join(seeds, ["query", "vector"], "left").select("query_group", "vector", "query", F.coalesce("worst", F.lit(float("-inf"))).alias("worst"))
    seeded = seeded.repartition("query_group").sortWithinPartitions("query_group")
    answers = _searched(seeded.mapInArrow(reach, plan), points, k)
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    ranked = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


class _Roots:
    """Centres and radii of the roots of all block parts."""

    def __init__(self, tops: list[tuple[int, int, bytes, float]]):
        tops = sorted(tops, key=lambda t: t[:2])
        self.blocks, self.parts = (np.array([t[k] for t in tops], np.int64) for k in (0, 1))
        self.centres = np.zeros((len(tops), max((len(t[2]) // 8 for t in tops), default=0)))
        for row, t in zip(self.centres, tops, strict=True):
            centre = np.frombuffer(t[2])
            row[: len(centre)] = centre
        self.radii = np.array([t[3] for t in tops])
        self.lengths = np.sqrt((self.centres**2).sum(axis=1))

    def limits(self, queries: np.ndarray) -> np.ndarray:
        """What no score of the group of queries in each part can exceed."""
        centre, radius = root_of(queries)
        c = queries[centre]
        width = min(len(c), self.centres.shape[1])
        scores = self.centres[:, :width] @ c[:width]
        return bounds(scores[None, :], [radius], [np.sqrt((c**2).sum())], self.radii, self.lengths)[0]


def _dealt(rows: DataFrame, key: str, size: int, name: str) -> DataFrame:
    """Rows of each cell dealt into blocks of about ``size``, by a hash of their key."""
    parts = rows.groupBy("cell").agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))  # a row a cell
    block = F.col("cell").cast("long") * (1 << 32) + F.pmod(F.xxhash64(key, "vector"), F.col("parts"))
    return rows.join(F.broadcast(parts), "cell").withColumn(name, block)


def _runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with the same first columns, which sorting has brought together; such a run is of bounded size."""
    current, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != current and held:
                yield current, held
                held = []
            current = row[:keys]
            held.append(row)
    if held:
        yield current, held


def _searched(asked: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(query_id, vector, vec_id, score): the best of each (query, part of a block) that is asked for."""
    none = F.lit(None)
    data = points.select("block", "part", F.lit(-1).cast("long").alias("query_group"), "vector", none.cast("long").alias("query"), none.cast("double").alias("worst"), "ids")
    both = data.unionByName(asked.withColumn("ids", none.cast("array<long>"))).repartition("block", "part").sortWithinPartitions("block", "part", "query_group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = vectors = ids = place = None
        for (block, part, group), found in _runs_of(batches, 3):
            if group < 0:
                vectors, ids, place = _vectors([r[3] for r in found]), [r[6] for r in found], (block, part)
                tree = None
                continue
            if (block, part) != place:
                continue
            queries = _vectors([r[3] for r in found])
            width = max(queries.shape[1], vectors.shape[1])
            queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
            if vectors.shape[1] != width:
                vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
            tree = tree or cover_tree(vectors)
            group_search = Search(np.array([r[4] for r in found]), queries, k, np.array([r[5] for r in found]))
            group_search.over(tree, vectors, ids)
            rows = [(found[i][4], found[i][3], -other, score) for i, heap in enumerate(group_search.best) for score, other in heap]
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vector", "vec_id", "score"])

    return both.mapInArrow(run, "query_id long, vector binary, vec_id long, score long")
