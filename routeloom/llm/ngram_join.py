"""Jaccard join of documents over word n-grams as a blocked sparse matrix product.

The incidence matrix has a row for each document and a column for each n-gram.
It is cut into blocks of documents by blocks of columns (ranges of the hash), and
such a block is one binary value, so millions of entries travel as one record.

1. *Column sums.*  A column that one document alone has adds to no overlap.  The
   entries of a row in other columns bound its overlap with anything, and rows
   whose bound is below the share their size asks for are discarded.  This is done
   once with shorter columns for all rows, then exactly for the rows that stay.  Blocks
   sum their own columns first, and ranges are cut by the size of the input.
2. *Bound by size.*  Of the columns of a row, rarest first, a partner must share
   one of the first ``n - need(n) + 1``.  Rows with such a column in common are
   tied together; the ties' components are the diagonal blocks of the product.
3. *Product.*  Each diagonal block is multiplied with itself, by sub-blocks of
   bounded size and of sizes that can match at all; overlap counts add up column
   by column, and pairs below ``need`` are discarded.  A large block is multiplied
   with a few of its rows first; what that connects is not multiplied again.

Documents with equal sets are one row of the matrix (their class, named by the
least id); a shingle is its 64-bit hash, which nothing verifies.  A task puts out a spanning forest of the links it found, which keeps
every connection and never all pairs of a group.

Defined results: null and empty texts have no shingle and no link, they are their
own component; rows with the same id share its component (links of either are
the id's links); a null id takes no part in links and has a null component; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.llm.components import components
from routeloom.llm.shingles import mix, shingle_sets
from routeloom.session import dropped, ship, tables_written, written

#: Entries of a block of rows, and bytes of text turned into shingles at a time.
BLOCK_ENTRIES, SLICE_BYTES = 1_000_000, 1_000_000
#: Bytes of text that a range of columns stands for, ranges a partition, and most ranges (as a power of two).
RANGE_BYTES, RANGES_A_PART, MOST_BITS = 4_000_000, 4, 20
#: Rows and entries of a sub-block of the product.
PRODUCT_ROWS, PRODUCT_ENTRIES = 512, 600_000
#: Columns of at least so many rows of a sub-block are multiplied densely; of thinner ones so many products at a time.
DENSE, EXPANDED = 24, 1_000_000
#: Rows of a large family that all its rows are compared with first, and how often that is done.
HUBS, HUB_TURNS = 64, 1
#: Tasks that rows with equal sets are dealt over.
SALTS = 64


def need(n, percent: int):
    """Least overlap that a row of ``n`` entries must have with a partner."""
    return (percent * n + 99) // 100


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, pa.Array]]:
    sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
    first, total = 0, 0
    for k, size in enumerate(sizes.tolist()):
        total += size
        if total >= SLICE_BYTES or k == len(sizes) - 1:
            yield batch.column(0).slice(first, k + 1 - first), batch.column(1).slice(first, k + 1 - first)
            first, total = k + 1, 0


class _Rows:
    """Rows of the matrix that a task has gathered for its next block."""

    def __init__(self, task: int):
        self.task, self.blocks = task, 0
        self.clear()

    def clear(self):
        self.ids, self.sets, self.entries = [], [], 0

    def name(self) -> int:
        self.blocks += 1
        return (self.task << 32) | self.blocks


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(name, ids, sizes, all entries in a row) of blocks of documents."""
    from pyspark import TaskContext

    rows = _Rows(TaskContext.get().partitionId())

    def made():
        sizes = np.array([len(s) for s in rows.sets], np.int64)
        out = rows.name(), np.concatenate(rows.ids), sizes, np.concatenate(rows.sets)
        rows.clear()
        return out

    for batch in batches:
        for ids, texts in _text_slices(batch):
            rows.ids.append(ids.to_numpy(zero_copy_only=False).astype(np.int64))
            for s in shingle_sets(texts, width):
                rows.sets.append(s)
                rows.entries += len(s)
            if rows.entries >= BLOCK_ENTRIES:
                yield made()
    if rows.sets:
        yield made()


def _cut(sizes: np.ndarray, entries: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(range of columns, entries of each row in it, these entries): what one block has in each range."""
    row = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    target = (entries >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    target, row, entries = target[order], row[order], entries[order]
    edges = np.searchsorted(target, np.arange((1 << bits) + 1))
    for k in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(edges[k], edges[k + 1])
        yield k, np.bincount(row[part], minlength=len(sizes)).astype(np.uint32), entries[part]


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_BLOCK = pa.schema([("target", pa.int64()), ("block", pa.int64()), ("counts", pa.binary()), ("entries", pa.binary())])
_BLOCK_DDL = "target long, block long, counts binary, entries binary"
_HEAD = -1  # target of the record that has a block's ids


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Records of the same first column, which sorting has brought together."""
    current, held = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for row in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                if row[0] != current:
                    if held:
                        yield current, held
                    current, held = row[0], []
                held.append(row)
    if held:
        yield current, held


def _bits(docs: DataFrame) -> int:
    """Ranges of columns, as a power of two, by the bytes of all texts: one range stays small at every size."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(MOST_BITS, max(4, (size // RANGE_BYTES).bit_length()))


def _parts(bits: int) -> int:
    return max(8, (1 << bits) // RANGES_A_PART)


def _repeats(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which entries stand in columns that the block has more than once, these columns sorted)."""
    repeated = _repeated(entries)
    return _member(entries, repeated), repeated


def _shared_bound(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """(doc_id, n, fp1, fp2, shared) of every row: size, fingerprints, and entries in columns that more rows have.

    A column that a block has more than once is summed there: its entries count at
    once, and the column itself travels one time, so a column of all rows is as many
    entries as there are blocks.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, sizes, entries in _blocks(batches, width):
            marks = [_fingerprints(sizes, entries, k) for k in (1, 2)]
            often, columns = _repeats(entries)
            row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            inside = np.bincount(row[often], minlength=len(sizes)).astype(np.uint64)
            lone = sizes - inside.astype(np.int64)
            yield _batch(_BLOCK, [(_HEAD - name % 1024, name, ids.tobytes(), np.concatenate([sizes.astype(np.uint64), *marks, inside]).tobytes())])
            low = np.uint64(64 - bits - 32)
            edges = np.searchsorted(columns >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            rest = {k: (counts, part) for k, counts, part in _cut(lone, entries[~often], bits)}
            for k in sorted(rest.keys() | set(np.flatnonzero(np.diff(edges)).tolist())):
                counts, part = rest.get(k, (np.zeros(0, np.uint32), entries[:0]))
                part = np.concatenate([part, columns[edges[k] : edges[k + 1]]])
                yield _batch(_BLOCK, [(k, name, counts.astype(np.uint32).tobytes(), (part >> low).astype(np.uint32).tobytes())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for target, rows in _runs(batches):
            if target <= _HEAD:
                for row in rows:
                    yield _batch(_BLOCK, [row])
                continue
            parts = [np.frombuffer(r[3], np.uint32) for r in rows]
            common = _repeated(np.concatenate(parts))
            for (_, name, counts, _), part in zip(rows, parts, strict=True):
                counts = np.frombuffer(counts, np.uint32)
                if not len(counts):
                    continue
                inside = _member(part[: counts.sum()], common)
                row = np.repeat(np.arange(len(counts)), counts)[inside]
                yield _batch(_BLOCK, [(target, name, np.bincount(row, minlength=len(counts)).astype(np.uint16 if counts.max(initial=0) < 65536 else np.uint32).tobytes(), b"")])

    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("shared", pa.int64())])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(pa.RecordBatch.from_arrays([b.column(i) for i in (1, 0, 2, 3)], ["block", "target", "counts", "entries"]) for b in batches):
            head = next(r for r in rows if r[1] <= _HEAD)
            ids = np.frombuffer(head[2], np.int64)
            n, fp1, fp2, inside = np.frombuffer(head[3], np.uint64).reshape(4, -1).view(np.int64)
            shared = inside.copy()
            for r in rows:
                if r[1] > _HEAD:
                    shared += np.frombuffer(r[2], np.uint16 if len(r[2]) == 2 * len(ids) else np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(x) for x in (n, fp1, fp2, shared))], schema=out)

    parts = _parts(bits)
    cut = docs.mapInArrow(split, _BLOCK_DDL).repartition(parts, "target").sortWithinPartitions("target")
    summed = cut.mapInArrow(sums, _BLOCK_DDL).repartition(parts, "block").sortWithinPartitions("block")
    return summed.mapInArrow(gathered, "doc_id long, n long, fp1 long, fp2 long, shared long")


def _fingerprints(sizes: np.ndarray, entries: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        begins = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        out[full] = np.add.reduceat(mix(entries ^ np.uint64(k * 0x9E3779B9)), begins)
    return out


def _repeated(values: np.ndarray) -> np.ndarray:
    """The values that come more than once, sorted."""
    values = np.sort(values)
    return np.unique(values[1:][values[1:] == values[:-1]])


def _member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_set, values), len(sorted_set) - 1)
    return sorted_set[at] == values


def _reduced_rows(docs: DataFrame, width: int, bits: int, percent: int) -> DataFrame:
    """(doc_id, n, keys, size, entries): rows that may still have a partner, with their shared columns and the keys of step 2.

    A block sends each of its columns once, with the rows it has there; the sums come
    back to the block, which has kept its entries.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, sizes, entries in _blocks(batches, width):
            yield _batch(_BLOCK, [(_HEAD - name % 1024, name, np.concatenate([ids, sizes]).tobytes(), entries.tobytes())])
            columns, degree = np.unique(entries, return_counts=True)
            edges = np.searchsorted(columns >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            for k in np.flatnonzero(np.diff(edges)).tolist():
                part = slice(edges[k], edges[k + 1])
                yield _batch(_BLOCK, [(k, name, degree[part].astype(np.uint32).tobytes(), columns[part].tobytes())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for target, rows in _runs(batches):
            if target <= _HEAD:
                for row in rows:
                    yield _batch(_BLOCK, [row])
                continue
            parts = [np.frombuffer(r[3], np.uint64) for r in rows]
            columns, where = np.unique(np.concatenate(parts), return_inverse=True)
            degree = np.bincount(where, np.concatenate([np.frombuffer(r[2], np.uint32) for r in rows])).astype(np.uint32)
            for row, part in zip(rows, parts, strict=True):
                found = degree[np.searchsorted(columns, part)]
                more = found > 1
                if more.any():
                    yield _batch(_BLOCK, [(target, row[1], found[more].tobytes(), part[more].tobytes())])

    out = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("size", pa.int64()), ("entries", pa.binary())])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(pa.RecordBatch.from_arrays([b.column(i) for i in (1, 0, 2, 3)], ["block", "target", "counts", "entries"]) for b in batches):
            head = next(r for r in rows if r[1] <= _HEAD)
            ids, sizes = np.frombuffer(head[2], np.int64).reshape(2, -1)
            body = [r for r in rows if r[1] > _HEAD]
            if not body:
                continue
            columns, found = (np.concatenate([np.frombuffer(r[k], t) for r in body]) for k, t in ((3, np.uint64), (2, np.uint32)))
            order = np.argsort(columns)
            columns, found = columns[order], found[order]
            values = np.frombuffer(head[3], np.uint64)
            inside = _member(values, columns)
            row, values = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)[inside], values[inside]
            order = np.lexsort((values, found[np.searchsorted(columns, values)], row))  # rarest first
            row, values = row[order], values[order]
            edges = np.searchsorted(row, np.arange(len(ids) + 1))
            made = []
            for k in range(len(ids)):
                own, n = values[edges[k] : edges[k + 1]], int(sizes[k])
                room = n - need(n, percent) + 1 - (n - len(own))  # of the prefix, what the lone columns leave
                if room > 0 and len(own):
                    made.append((int(ids[k]), n, own[:room].view(np.int64).tolist(), len(own), np.sort(own).tobytes()))
                if len(made) == 512 or made and k == len(ids) - 1:
                    yield _batch(out, made)
                    made = []

    parts = _parts(bits)
    cut = docs.mapInArrow(split, _BLOCK_DDL).repartition(parts, "target").sortWithinPartitions("target")
    summed = cut.mapInArrow(sums, _BLOCK_DDL).repartition(parts, "block").sortWithinPartitions("block")
    return summed.mapInArrow(gathered, "doc_id long, n long, keys array<long>, size long, entries binary")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Matrix of overlap counts of two lists of sets (sorted, distinct)."""
    counts = np.zeros((len(left), len(right)), np.float32)
    sides = []
    for sets in (left, right):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sides.append((row, values))
    columns, where = np.unique(np.concatenate([s[1] for s in sides]), return_inverse=True)
    a_row, b_row = sides[0][0], sides[1][0]
    a_col, b_col = where[: len(a_row)], where[len(a_row) :]
    a_sum, b_sum = (np.bincount(c, minlength=len(columns)) for c in (a_col, b_col))
    dense = np.flatnonzero((np.minimum(a_sum, b_sum) > 0) & (np.maximum(a_sum, b_sum) >= DENSE))
    place = np.full(len(columns), -1)
    for at in range(0, len(dense), 4096):
        place[:] = -1
        some = dense[at : at + 4096]
        place[some] = np.arange(len(some))
        blocks = []
        for rows, cols, height in ((a_row, a_col, len(left)), (b_row, b_col, len(right))):
            m = np.zeros((height, len(some)), np.float32)
            inside = place[cols] >= 0
            m[rows[inside], place[cols[inside]]] = 1
            blocks.append(m)
        counts += blocks[0] @ blocks[1].T
    thin = (np.minimum(a_sum, b_sum) > 0) & (np.maximum(a_sum, b_sum) < DENSE)
    inside = thin[b_col]
    order = np.argsort(b_col[inside], kind="stable")
    col, row = b_col[inside][order], b_row[inside][order]
    first = np.searchsorted(col, np.arange(len(columns) + 1))
    inside = thin[a_col]
    a_r, a_c = a_row[inside], a_col[inside]
    many = first[a_c + 1] - first[a_c]
    total = np.cumsum(many)
    ends = np.searchsorted(total, np.arange(EXPANDED, (total[-1] if len(total) else 0) + EXPANDED, EXPANDED))
    at = 0
    for end in np.minimum(ends + 1, len(a_c)).tolist():  # a column adds less than DENSE products at a time
        some, at = slice(at, end), end
        pair_a = np.repeat(a_r[some], many[some])
        within = np.arange(len(pair_a)) - np.repeat(total[some] - many[some] - (total[some.start - 1] if some.start else 0), many[some])
        pair_b = row[np.repeat(first[a_c[some]], many[some]) + within]
        counts += np.bincount(pair_a * len(right) + pair_b, minlength=counts.size).reshape(counts.shape).astype(np.float32)
    return counts


def _stars(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Each node of the links (a, b) with the least node that they connect it to."""
    top: dict[int, int] = {}

    def root(x):
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            top[max(p, q)] = min(p, q)
    return [(x, root(x)) for x in top if root(x) != x]


def _product(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    """What the links of one sub-block connect; rows (task, side, doc_id, n, entries), side 0 with itself or with side 1."""
    sides = [[r for r in rows if r[1] == k] for k in (0, 1)]
    left, right = sides[0], sides[1] or sides[0]
    if not left:
        return []
    ids = [np.array([r[2] for r in s]) for s in (left, right)]
    sizes = [np.array([r[3] for r in s], np.int64) for s in (left, right)]
    sets = [[np.frombuffer(r[4], np.uint64) for r in s] for s in (left, right)]
    if len(left) * len(right) <= 16:
        found = [(i, j) for i in range(len(left)) for j in range(len(right)) if ids[0][i] != ids[1][j]]
        found = [(i, j) for i, j in found if 100 * min(sizes[0][i], sizes[1][j]) >= percent * max(sizes[0][i], sizes[1][j])]
        both = np.array([len(np.intersect1d(sets[0][i], sets[1][j], assume_unique=True)) for i, j in found], np.int64)
        i, j = (np.array([f[k] for f in found], np.int64) for k in (0, 1))
    else:
        table = overlaps(*sets)
        i, j = np.nonzero(table)
        both = table[i, j].astype(np.int64)
    keep = 100 * both >= percent * (sizes[0][i] + sizes[1][j] - both)
    a, b = ids[0][i[keep]], ids[1][j[keep]]
    return _stars(a[a != b], b[a != b])


def _families(keyed: DataFrame) -> DataFrame:
    """(doc_id, family) of the rows that share a key with another row."""
    tied = keyed.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("key", "first")
    ties = keyed.join(tied, "key").where("doc_id <> first").select(F.col("doc_id").alias("u"), F.col("first").alias("v"))
    return components(ties).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "family")


def _open_keys(keyed: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key has rows of more than one component of ``known`` (node, component)."""
    placed = keyed.join(known.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("part"))
    live = placed.groupBy("key").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most").select("key")
    return keyed.join(live, "key")


def _multiplied(placed: DataFrame, percent: int) -> DataFrame:
    """(u, v): links of sub-blocks (task, side, doc_id, n, entries)."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: list[tuple[int, int]] = []
        for _, found in _runs(batches):
            links += _product(found, percent)
            if len(links) > 50_000:
                yield _batch(out, links)
                links = []
        if links:
            yield _batch(out, links)

    return placed.repartition("task").sortWithinPartitions("task", "side").mapInArrow(multiply, "u long, v long")


def _with_hubs(member: DataFrame, total: DataFrame, turn: int, percent: int) -> DataFrame:
    """(u, v): links between each row of a large family and the family's hubs, which a hash picks."""
    large = total.where(~F.col("one")).withColumn("parts", F.greatest(F.ceil(F.col("rows") / PRODUCT_ROWS), F.ceil(F.col("sum") / PRODUCT_ENTRIES)).cast("int"))
    rows = member.join(large.select("family", "rows", "parts"), "family")
    task = lambda part: F.xxhash64("family", part)
    own = rows.select(task(F.pmod(F.xxhash64("doc_id"), "parts").cast("int")).alias("task"), F.lit(0).alias("side"), "doc_id", "n", "entries")
    hubs = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(turn)), "rows") < HUBS)
    hubs = hubs.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(task(F.col("part")).alias("task"), F.lit(1).alias("side"), "doc_id", "n", "entries")
    return _multiplied(own.unionByName(hubs), percent)


def _links(rows: DataFrame, percent: int) -> DataFrame:
    """(u, v): links that connect what all links connect.

    A family (diagonal block) that is too large for one product is first compared with a
    few of its rows, the hubs.  Rows whose keys are then all within one component need no
    more work, as whatever they could link with is in it already; the rest is
    multiplied in full.
    """
    found: list[DataFrame] = []
    keyed = written(rows.select(F.explode("keys").alias("key"), "doc_id"), "keys")
    for turn in range(HUB_TURNS + 1):
        family = _families(keyed)
        light = written(rows.select("doc_id", "size").join(family, "doc_id"), "family")
        total = light.groupBy("family").agg(F.count("*").alias("rows"), F.sum("size").alias("sum"))
        total = total.withColumn("one", (F.col("rows") <= PRODUCT_ROWS) & (F.col("sum") <= PRODUCT_ENTRIES))
        member = rows.select("doc_id", "n", "size", "entries").join(light.select("doc_id", "family").distinct(), "doc_id")
        if turn == HUB_TURNS or total.where(~F.col("one")).isEmpty():
            break
        found.append(written(_with_hubs(member, total, turn, percent), "hub_links"))
        keyed = written(_open_keys(keyed, components(_all(found))), "keys")
    return _all([*found, _all_pairs(member, total, percent)])


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _all_pairs(member: DataFrame, total: DataFrame, percent: int) -> DataFrame:
    """(u, v): a spanning forest of the links within each family, by sub-blocks of sizes that can match."""
    step = float(np.log(100.0 / percent)) if percent < 100 else 1.0
    member = member.withColumn("class", F.floor(F.ln("n") / step + 1e-9).cast("int"))
    light = member.select("family", "class", "size")
    per = light.groupBy("family", "class").agg(F.greatest(F.ceil(F.count("*") / PRODUCT_ROWS), F.ceil(F.sum("size") / PRODUCT_ENTRIES)).cast("int").alias("parts"))
    around = per.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("class", "parts"))).alias("parts"))
    member = member.join(total.select("family", "one").join(around, "family"), "family")

    own = F.element_at("parts", F.col("class"))
    mine = F.pmod(F.xxhash64("doc_id"), own).cast("int")
    beside = lambda d: F.coalesce(F.try_element_at("parts", F.col("class") + d), F.lit(0))
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    name = lambda c, i, d, j, side: F.struct(c.alias("c"), i.cast("int").alias("i"), d.alias("d"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    c = F.col("class")
    tasks = F.concat(
        F.transform(upto(own), lambda j: F.when(j >= F.col("mine"), name(c, F.col("mine"), c, j, 0)).otherwise(name(c, j, c, F.col("mine"), 1))),
        F.transform(upto(beside(1)), lambda j: name(c, F.col("mine"), c + 1, j, 0)),
        F.transform(upto(beside(-1)), lambda j: name(c - 1, j, c, F.col("mine"), 1)),
    )
    zero = F.lit(0)
    placed = (
        member.withColumn("mine", mine)
        .withColumn("task", F.explode(F.when(F.col("one"), F.array(name(F.lit(-1), zero, F.lit(-1), zero, 0))).otherwise(tasks)))
        .select(F.xxhash64("family", "task.c", "task.i", "task.d", "task.j").alias("task"), F.col("task.side").alias("side"), "doc_id", "n", "entries")
    )
    return _multiplied(placed, percent)


def ngram_components(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their
    sets of distinct ``width``-word shingles; components are those of the links.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = rows.where("doc_id is not null")
    bits = _bits(known)
    bound = written(_shared_bound(known, width, bits).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")), "bound")
    # rows of one class are dealt over salts, so that a class of many copies is no single task's
    salted = written(bound.where("n > 0").groupBy("n", "fp1", "fp2", "salt").agg(F.min("doc_id").alias("least")), "salted")
    classes = salted.groupBy("n", "fp1", "fp2").agg(F.min("least").alias("head"))
    able = bound.where(f"n > 0 and 100 * shared >= {percent} * n").select("n", "fp1", "fp2").distinct()
    stay = written(classes.join(able, ["n", "fp1", "fp2"]).select(F.col("head").alias("doc_id")).distinct(), "stay")
    reduced = written(_reduced_rows(known.join(stay, "doc_id", "left_semi"), width, bits, percent), "reduced")
    before = tables_written()
    found = components(_links(reduced, percent)).withColumnRenamed("node", "head")
    dropped(docs.sparkSession, before - 1, keep=1)  # all but what the components are read from
    named = salted.join(classes, ["n", "fp1", "fp2"]).select("n", "fp1", "fp2", "salt", "head")
    heads = bound.join(named, ["n", "fp1", "fp2", "salt"], "left").select("doc_id", "n", F.coalesce("head", "doc_id").alias("head"))
    placed = heads.join(found, "head", "left").select("doc_id", "n", F.coalesce("component", "head").alias("component"))
    # rows that share an id share its component
    twice = placed.groupBy("doc_id").agg(F.min("component").alias("least"), F.count_distinct("component").alias("kinds")).where("kinds > 1")
    if not twice.isEmpty():
        merged = components(placed.join(twice, "doc_id").select(F.col("component").alias("u"), F.col("least").alias("v")))
        placed = placed.join(merged, placed["component"] == merged["node"], "left").select("doc_id", "n", F.coalesce(merged["component"], placed["component"]).alias("component"))
    lost = rows.where("doc_id is null").select("doc_id", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("component"))
    return placed.union(lost).select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component (or null), with all columns."""
    found = ngram_components(docs, width, percent, id_col, text_col)
    gone = written(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone_id")).distinct(), "gone")
    return docs.join(gone, docs[id_col] == gone["_gone_id"], "left_anti")
