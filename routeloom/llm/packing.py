"""Best-fit packing of token sequences in bulk-synchronous sweeps.

Documents are tokenized once and cut into pieces of at most ``capacity`` tokens.
There are two tables: pieces without a place, and open sequences with their gaps.  A
superstep takes the pieces of one band of lengths, the longest band first:

1. pieces and gaps are range-sorted by size, with ids as a tie-break, so a size that
   a third of all rows have is dealt over many ranges too;
2. their ranks in that order deal both into stripes, every n-th piece with every n-th
   gap: no two stripes can want the same gap, and each has its share of every size;
3. in each stripe sweeps go from the longest pieces to the shortest.  All pieces of a
   length look up their successor, the smallest gap that holds them; the i-th piece
   takes the i-th sequence of that gap, these gaps shrink, and pieces beyond the last
   sequence sweep again over the gaps that are left; where none holds them, new
   sequences open;
4. placed pieces and the changed gaps are written, and the next superstep takes the gaps.

A stripe has about ``STRIPE_ROWS`` pieces however many there are in all, and ends with
one badly filled sequence at most, so stripes cost no more than one sequence each.

Defined results: a null text counts as empty and becomes a piece that holds the
end id alone; null ids are kept; repeated rows are packed each by itself; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from routeloom.llm.token_counts import BATCH_CHARS, load_tokenizer
from routeloom.session import ship, written

#: Words that a Python process remembers the ids of, in each of two generations.
REMEMBERED = 250_000
#: Least lengths of the bands, as shares of the capacity; pieces of a stripe.
BANDS, STRIPE_ROWS = (1 / 4, 1 / 16, 0.0), 50_000

#: Code points for which the normalizer does nothing but lower-case and for which
#: letters, digits and white space are told apart here as the library does.
_LETTERS = "a-zA-ZÀ-ÖØ-öø-įĲ-ňŊ-ž"
_PLAIN = re.compile(f"[\t\n\r -~¡«»¿{_LETTERS}]*")
_WORDS = re.compile(f"[{_LETTERS}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\\s{_LETTERS}0-9]+")


class WordIds:
    """Ids of whole texts as bytes (little-endian unsigned 32-bit).

    The tokenizer's normalizer and pre-tokenizer treat a text of plain code points
    word by word, so the ids of a word, once had from the library, serve for each
    time it comes.  Any other text, or one with an added token, goes to the
    library as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.ends = _for_words(self.tokenizer)
        self.by_word = _works_by_word(self.tokenizer, self.words, self.ends)

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        """Ids of ``texts``; words not met before are encoded together."""
        split = [_WORDS.findall(x.lower()) if self._plain(x) else None for x in texts]
        known = self.known
        fresh = set(chain.from_iterable(x for x in split if x)).difference(known)
        if len(known) + len(fresh) > REMEMBERED:  # words that were not met for a generation are forgotten
            self.older, self.known = known, {w: known[w] for x in split if x for w in x if w in known}
            known = self.known
        older = self.older
        met = [w for w in fresh if w in older]  # intersecting with a dict would walk all of it
        known.update((w, older[w]) for w in met)
        fresh = list(fresh.difference(met))
        if fresh:
            ids = _word_by_word(self.words, fresh)
            raw, ends = ids.tobytes(), (np.flatnonzero(self.ends[ids]) * 4 + 4).tolist()
            known.update(zip(fresh, [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))
        return [
            _packed(self.tokenizer.encode(text, add_special_tokens=False).ids) if words is None else b"".join(map(known.__getitem__, words))
            for text, words in zip(texts, split, strict=True)
        ]

    def _plain(self, text: str) -> bool:
        return self.by_word and _PLAIN.fullmatch(text) is not None and not any(x in text for x in self.special)


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _for_words(tokenizer) -> tuple[Tokenizer, np.ndarray]:
    """The tokenizer's model for words that are normalized and apart already; which ids end a word."""
    words = Tokenizer(tokenizer.model)
    words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    suffix, vocabulary = getattr(tokenizer.model, "end_of_word_suffix", None), tokenizer.get_vocab()
    ends = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
    ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
    return words, ends


def _word_by_word(tokenizer, words: list[str]) -> np.ndarray:
    """Ids of words without white space, one after the other."""
    return np.asarray(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")


def _works_by_word(tokenizer, words, ends: np.ndarray) -> bool:
    """True for a lower-casing tokenizer that drops white space, splits as ``_WORDS`` does and marks ends of words."""
    probe = "It's THE Été 12 x9, don't--stop!  «Ça» we'll\n\tABC'd 3.5"
    whole, split = tokenizer.encode(probe, add_special_tokens=False).ids, _WORDS.findall(probe.lower())
    apart = _word_by_word(words, split)
    return whole == apart.tolist() and int(ends[apart].sum()) == len(split) and tokenizer.encode(probe.lower(), add_special_tokens=False).ids == whole


_WORD_IDS: dict[str, WordIds] = {}


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of about ``BATCH_CHARS`` code points each."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def pieces_of(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all documents."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _WORD_IDS:
            _WORD_IDS[tokenizer_path] = WordIds(tokenizer_path)
        ids_of, last = _WORD_IDS[tokenizer_path], _packed([end_id])
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for first, texts in _slices(batch.column(1).to_pylist()):
                for k, ids in enumerate(ids_of.many(texts), first):
                    ids += last
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        row.append(k)
                        piece.append(n)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def plan_sweeps(counts: dict[int, int], capacity: int, gaps: dict[int, list[tuple[int, int]]] | None = None, opened: int = 0) -> np.ndarray:
    """Plan rows (length, first rank, how many, first sequence, offset), by length and rank.

    ``counts``: pieces of each length.  ``gaps``: of each gap the runs (first
    sequence, how many) that have it; ``opened``: the next new sequence.
    """
    if counts and (max(counts) > capacity or min(counts) < 1):
        raise ValueError("lengths must lie between 1 and the capacity")
    gaps = {g: list(runs) for g, runs in (gaps or {}).items() if g > 0}
    sizes = sorted(gaps)
    plan = []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                fresh = -(-left // (capacity // length))
                gaps[capacity] = [(opened, fresh)]
                sizes.append(capacity)
                opened += fresh
            shrunk: dict[int, list[tuple[int, int]]] = {}
            end = at
            while end < len(sizes) and left:
                gap = sizes[end]
                runs = gaps[gap]
                while runs and left:
                    first, n = runs.pop()
                    take = min(n, left)
                    plan.append((length, rank, take, first, capacity - gap))
                    rank, left = rank + take, left - take
                    shrunk.setdefault(gap - length, []).append((first, take))
                    if take < n:
                        runs.append((first + take, n - take))
                if runs:
                    break
                del gaps[gap]
                end += 1
            del sizes[at:end]
            for gap, runs in shrunk.items():
                if gap:
                    if gap not in gaps:
                        insort(sizes, gap)
                    gaps[gap] = _joined(gaps.get(gap, []) + runs)
    return np.array(plan, np.int64).reshape(-1, 5)


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of neighbouring sequences made one."""
    out: list[tuple[int, int]] = []
    for first, n in sorted(runs):
        if out and out[-1][0] + out[-1][1] == first:
            out[-1] = (out[-1][0], out[-1][1] + n)
        else:
            out.append((first, n))
    return out


def sweep(lengths: np.ndarray, gaps: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence of each piece, its offset, gap of each sequence) after the sweeps of one stripe.

    The first sequences are those of ``gaps``; new ones come behind them.
    """
    order = np.argsort(gaps, kind="stable")  # sequences of a gap become a run
    size, at, n = np.unique(gaps[order], return_index=True, return_counts=True)
    runs = {g: [(a, m)] for g, a, m in zip(size.tolist(), at.tolist(), n.tolist(), strict=True)}
    length, count = np.unique(lengths, return_counts=True)
    plan = plan_sweeps(dict(zip(length.tolist(), count.tolist(), strict=True)), capacity, runs, len(gaps))
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    many = plan[:, 2]
    within = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    piece = np.argsort(lengths, kind="stable")  # by length and then by rank, as the plan
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    sequence[piece] = np.repeat(plan[:, 3], many) + within
    offset[piece] = np.repeat(plan[:, 4], many)
    total = max(len(gaps), int(sequence.max(initial=-1)) + 1)
    left = np.full(total, capacity, np.int64)
    left[: len(gaps)] = gaps[order]
    left -= np.bincount(sequence, lengths, minlength=total).astype(np.int64)
    name = np.arange(total)
    name[: len(gaps)] = order  # back to the order in which the gaps came
    back = np.empty(total, np.int64)
    back[name] = left
    return name[sequence], offset, back


def _stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of each stripe, which sorting by the first column has brought together."""
    current, held = None, []
    for batch in batches:
        stripe = batch.column(0).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(stripe)) + 1).tolist(), len(stripe)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if a == b:
                continue
            if stripe[a] != current and held:
                yield int(current), pa.Table.from_batches(held)
                held = []
            current = stripe[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield int(current), pa.Table.from_batches(held)


def _superstep(pieces: DataFrame, gaps: DataFrame | None, step: int, stripes: int, capacity: int) -> DataFrame:
    """Places of ``pieces`` (sequence_id, offset) and, as rows without a piece, the gaps after them."""
    none = F.lit(None)
    rows = pieces.select(F.lit(False).alias("is_gap"), F.col("length").alias("size"), *PIECE, none.cast("long").alias("sequence_id"))
    if gaps is not None:
        kinds = dict(pieces.dtypes)
        rows = rows.unionByName(gaps.select(F.lit(True).alias("is_gap"), F.col("gap").alias("size"), *[none.cast(kinds[c]).alias(c) for c in PIECE], "sequence_id"))
    order = ("is_gap", "size", "sequence_id", "doc_id", "piece", "ids_crc32")
    ranked = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("stripe", F.pmod(F.monotonically_increasing_id(), F.lit(stripes)).cast("long"))
    dealt = ranked.select("stripe", *rows.columns).repartition(stripes, "stripe").sortWithinPartitions("stripe", *order)
    kind = pieces.schema["doc_id"].dataType.simpleString()
    names = [*PIECE, "sequence_id", "offset", "gap"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stripe, table in _stripes(batches):
            is_gap = table.column("is_gap").to_numpy()
            size = table.column("size").to_numpy()
            sequence, offset, left = sweep(size[~is_gap], size[is_gap], capacity)
            fresh = (step << 56) + (stripe << 28) + np.arange(len(left))
            fresh[: is_gap.sum()] = table.column("sequence_id").filter(pa.array(is_gap)).to_numpy()
            own = table.filter(pa.array(~is_gap)).select([*PIECE]).combine_chunks()
            open_ = left > 0
            n = int(open_.sum())
            made = [*(own.column(c) for c in PIECE), pa.array(fresh[sequence]), pa.array(offset), pa.nulls(len(own), pa.int64())]
            held = [*(pa.nulls(n, own.schema.field(c).type) for c in PIECE), pa.array(fresh[open_]), pa.nulls(n, pa.int64()), pa.array(left[open_])]
            for columns in (made, held):
                yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=10_000)

    return dealt.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, gap long")


PIECE = ("doc_id", "piece", "start", "length", "ids_crc32")


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(pieces_of(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces")
    stripes = max(1, -(-pieces.count() // STRIPE_ROWS))
    gaps, done, above = None, [], capacity + 1
    for step, share in enumerate(BANDS):
        least = max(1, int(capacity * share))
        band = pieces.where((F.col("length") >= least) & (F.col("length") < above))
        moved = written(_superstep(band, gaps, step, stripes, capacity), f"packed{step}")
        done.append(moved.where("gap is null").select(*PIECE, "sequence_id", "offset"))
        gaps, above = moved.where("gap is not null").select("sequence_id", "gap"), least
    packed = done[0]
    for part in done[1:]:
        packed = packed.unionByName(part)
    return packed.withColumnRenamed("doc_id", id_col)


def fill_rate(packed: DataFrame, capacity: int = 4096) -> pd.DataFrame:
    """Sequences, tokens and the share of the sequences' room that tokens fill."""
    return packed.agg(
        F.countDistinct("sequence_id").alias("sequences"), F.sum("length").alias("tokens"), (F.sum("length") / (F.countDistinct("sequence_id") * F.lit(capacity))).alias("filled")
    ).toPandas()
