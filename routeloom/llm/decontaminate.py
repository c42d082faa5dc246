"""Benchmark decontamination by template canonicalisation.

Texts of both sides become sequences of template tokens: numbers, units after a
number and names (capitalised words inside a sentence) are typed placeholders, all
other words are in lower case.  A second form leaves names as words, so that
texts written all in capitals or all in small letters still match.  A third form has
no placeholder at all, so verbatim copies match however many numbers they hold; the
bound on placeholders in a window (``LEAST_LITERAL``) is for the first two.  Windows of
``window`` tokens are hash-joined with the windows of the benchmark (an item of
fewer tokens is one window).  Matching windows of a document and an item on one
diagonal make a run; a run counts if its slots are consistent: the values that stand
in the placeholders of the item must map one to one to those of the document.  So
a question with other numbers or names is found, while a text that only has
placeholders in the same places is not.  A run with a conflict is split: its longest
stretches of at least a window that are consistent in themselves count, and so does
every stretch of a window that is equal word for word.

A document is contaminated by an item when consistent runs cover ``least_words`` of
the item's tokens (or all of a shorter item).

The benchmark's windows are broadcast in groups of items of at most
``GROUP_TOKENS`` tokens; a larger benchmark takes more passes, so what is
broadcast is bounded whatever its size.

Defined results: null and empty texts and items match nothing; null item ids are
left out of ``items`` but still contaminate; repeated items count once each id;
repeated documents each give a row; an empty benchmark contaminates nothing;
other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.llm.shingles import mix, powers, slice_end, text_bytes
from routeloom.session import ship, written

WINDOW, LEAST_WORDS = 8, 13
#: Words of a window that must not be placeholders.
LEAST_LITERAL = 4
#: Benchmark tokens of a pass, at most.
GROUP_TOKENS = 1_000_000
#: Bytes of documents handled at a time.
SLICE_BYTES = 2_000_000

# Units of measure and number words.
UNITS = (
    "mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "mile", "miles", "yd", "yard", "yards",
    "mg", "g", "kg", "lb", "lbs", "oz", "ton", "tons", "ml", "l", "litre", "litres", "liter", "liters", "gallon", "gallons",
    "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks",
    "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "pound", "pounds", "cent", "cents",
    "percent", "degree", "degrees", "kmh", "mph", "hz", "khz", "mhz", "w", "kw", "v", "kb", "mb", "gb", "%", "$", "€", "£", "°",
)
NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve",
    "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty", "thirty", "forty",
    "fifty", "sixty", "seventy", "eighty", "ninety", "hundred", "thousand", "million",
)

_SLOTS = {"number": 11, "unit": 12, "name": 13}
_DOT, _COMMA, _QUOTE, _NEWLINE = b".,'\n"


def _word_hash(word: str) -> int:
    return int(lex(pa.array(["0 " + word]))[0][-1])


def _classes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each byte: 0 none, 1 letter, 2 digit, 3 unit sign; bytes in lower case).

    Bytes of code points from U+0080 on are letters, but for U+0080 to U+00BF, U+2000 to
    U+2FFF and U+3000 to U+303F, which are marks.  Lower case covers ASCII and Latin-1.
    """
    ascii_upper = (raw >= 65) & (raw <= 90)
    kind = np.zeros(len(raw), np.uint8)
    kind[ascii_upper | ((raw >= 97) & (raw <= 122)) | (raw >= 128)] = 1
    kind[(raw >= 48) & (raw <= 57)] = 2
    kind[(raw == 37) | (raw == 36)] = 3
    low = raw.copy()
    low[ascii_upper] += 32
    lead = np.flatnonzero(raw == 0xC3)
    lead = lead[lead + 1 < len(raw)]
    lead = lead[(raw[lead + 1] >= 0x80) & (raw[lead + 1] <= 0x9E) & (raw[lead + 1] != 0x97)]
    low[lead + 1] += 32
    for byte, more in ((0xC2, 1), (0xE2, 2)):
        at = np.flatnonzero(raw == byte)
        at = at[at + more < len(raw)]
        for k in range(more + 1):
            kind[at + k] = 0
        if byte == 0xC2:
            kind[at[np.isin(raw[at + 1], (0xA3, 0xB0))]] = 3
        else:
            kind[at[(raw[at + 1] == 0x82) & (raw[at + 2] == 0xAC)]] = 3
    at = np.flatnonzero(raw == 0xE3)
    at = at[at + 2 < len(raw)]
    at = at[raw[at + 1] == 0x80]
    for k in range(3):
        kind[at + k] = 0
    if len(raw) > 2:  # marks inside numbers and words belong to them
        inner = raw[1:-1]
        kind[1:-1][((inner == _DOT) | (inner == _COMMA)) & (kind[:-2] == 2) & (kind[2:] == 2)] = 2
        kind[1:-1][(inner == _QUOTE) & (kind[:-2] == 1) & (kind[2:] == 1)] = 1
    return kind, low


def _tokens(raw: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, classes with 4 added for a name-like word, places of stops) of ``raw``."""
    kind, low = _classes(raw)
    changes = np.ones(len(raw), bool)
    changes[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 3)
    changes[cuts[(cuts > 0) & (cuts < len(raw))]] = True
    stops = np.flatnonzero((kind == 0) & ((raw == _DOT) | (raw == 33) | (raw == 63) | (raw == 58) | (raw == _NEWLINE)))
    starts = np.flatnonzero(changes)
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(starts, append=len(raw)))
    value = low.astype(np.uint64)
    value += np.uint64(1)
    value *= powers(int(place.max(initial=0)) + 1)[place]
    hashes = np.add.reduceat(value, starts) if len(starts) else np.zeros(0, np.uint64)
    upper = low != raw
    count = np.add.reduceat(upper.astype(np.int32), starts) if len(starts) else np.zeros(0, np.int32)
    first = upper[starts] | ((raw[starts] == 0xC3) & upper[np.minimum(starts + 1, len(raw) - 1)])
    size = np.diff(starts, append=len(raw))
    name = first & (count == 1) & (size > np.where(raw[starts] == 0xC3, 2, 1))
    use = kind[starts] > 0
    return mix(hashes[use]), starts[use], (kind[starts] + 4 * name)[use], stops


def lex(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, slot types, number of the first token of each text and one more)."""
    raw, offsets = text_bytes(column)
    parts = [tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.uint8, np.int64))]
    at = 0
    while at < len(raw):
        end = slice_end(raw, at)
        hashes, starts, kinds, stops = _tokens(raw[at:end], offsets - at)
        parts.append((hashes, starts + at, kinds, stops + at))
        at = end
    hashes, starts, kinds, stops = (np.concatenate(x) for x in zip(*parts, strict=True))
    bounds = np.searchsorted(starts, offsets)
    stopped = np.searchsorted(stops, starts)
    after_stop = np.ones(len(starts), bool)
    after_stop[1:] = stopped[1:] > stopped[:-1]
    after_stop[bounds[:-1][bounds[:-1] < len(starts)]] = True
    number = (kinds & 3) == 2
    if _LISTS:
        number |= _isin(hashes, _LISTS["numbers"])
        behind = np.zeros(len(starts), bool)
        behind[1:] = number[:-1]
        behind[bounds[:-1][bounds[:-1] < len(starts)]] = False
        unit = behind & ~number
        unit[unit] = _isin(hashes[unit], _LISTS["units"])
    else:
        unit = np.zeros(len(starts), bool)
    name = (kinds >= 4) & ~after_stop & ~number & ~unit
    slots = np.where(number, _SLOTS["number"], np.where(unit, _SLOTS["unit"], np.where(name, _SLOTS["name"], 0))).astype(np.int64)
    keep = ((kinds & 3) != 3) | unit | (not _LISTS)  # a unit sign counts after a number alone
    count = np.concatenate([[0], np.cumsum(keep)])
    return hashes[keep], slots[keep], count[bounds]


def _isin(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    sieve = np.zeros(1 << 12, bool)
    sieve[listed & np.uint64(4095)] = True
    out = sieve[values & np.uint64(4095)]
    out[out] = np.isin(values[out], listed)
    return out


#: Hashes of the fixed lists, made from them on import.
_LISTS: dict[str, np.ndarray] = {}
_LISTS |= {name: np.array([_word_hash(w) for w in words], np.uint64) for name, words in (("units", UNITS), ("numbers", NUMBER_WORDS))}


def _forms(hashes: np.ndarray, slots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(template tokens, is placeholder) with names as placeholders, with names as words, and word for word."""
    typed = mix(slots.astype(np.uint64))
    yield np.where(slots > 0, typed, hashes), slots > 0
    apart = (slots > 0) & (slots != _SLOTS["name"])
    yield np.where(apart, typed, hashes), apart
    yield hashes, np.zeros(len(slots), bool)


def window_hashes(tokens: np.ndarray, holder: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, usable) of the windows that begin at each token."""
    n = len(tokens) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += tokens[k : k + n] * factors[k]
    sums = np.concatenate([[0], np.cumsum(holder)])
    literal = width - (sums[width:] - sums[:-width])
    usable = literal >= min(LEAST_LITERAL, width)
    ends = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(ends, bounds[1:-1], 1)
    text = np.cumsum(ends)
    usable &= text[:n] == text[width - 1 : width - 1 + n]
    return mix(total), usable


class Benchmark:
    """Items of one pass: tokens, slots, and an index of windows."""

    def __init__(self, items: list[tuple[int | None, str]], window: int):
        self.ids = [i for i, _ in items]
        self.window = window
        self.hashes, self.slots, self.bounds = lex(pa.array([t for _, t in items], pa.string()))
        self.index: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        sizes = np.diff(self.bounds)
        lengths = sorted({int(min(window, s)) for s in sizes if s})
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for form, (tokens, holder) in enumerate(_forms(self.hashes, self.slots)):
            for width in lengths:
                h, usable = window_hashes(tokens, holder, self.bounds, width)
                # a narrower window stands for an item as a whole
                at = np.flatnonzero(usable & (np.minimum(sizes, window)[owner[: len(h)]] == width))
                order = np.argsort(h[at], kind="stable")
                if len(at):
                    self.index[form, width] = (h[at][order], at[order])
        self.owner = owner

    def matches(self, hashes: np.ndarray, slots: np.ndarray, bounds: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
        """(text, item) -> (position in the texts, position in the items, width) of equal windows."""
        out = defaultdict(list)
        for form, (tokens, holder) in enumerate(_forms(hashes, slots)):
            for width in sorted({w for f, w in self.index if f == form}):
                known, at = self.index[form, width]
                h, usable = window_hashes(tokens, holder, bounds, width)
                sieve = np.zeros(1 << 20, bool)
                sieve[known & np.uint64((1 << 20) - 1)] = True
                some = np.flatnonzero(usable & sieve[h & np.uint64((1 << 20) - 1)])
                low, high = np.searchsorted(known, h[some], "left"), np.searchsorted(known, h[some], "right")
                for p, a, b in zip(some.tolist(), low.tolist(), high.tolist(), strict=True):
                    for q in at[a:b].tolist():
                        text = int(np.searchsorted(bounds, p, "right")) - 1
                        out[text, int(self.owner[q])].append((p, q, width))
        return out

    def covered(self, found: list[tuple[int, int, int]], hashes: np.ndarray, slots: np.ndarray) -> int:
        """Tokens of the item in runs with consistent slots."""
        diagonals = defaultdict(list)
        for p, q, width in found:
            diagonals[p - q].append((q, q + width))
        inside: set[int] = set()
        for shift, spans in diagonals.items():
            spans.sort()
            runs = [list(spans[0])]
            for a, b in spans[1:]:
                if a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            for a, b in runs:
                parts = self.stretches(a, b, shift, hashes, slots)
                if len(parts) > 1:
                    parts = self.chosen(parts) + self.verbatim(a, b, shift, hashes)
                for first, end in parts:
                    inside.update(range(first, end))
        return len(inside)

    def stretches(self, a: int, b: int, shift: int, hashes: np.ndarray, slots: np.ndarray) -> list[tuple[int, int]]:
        """Maximal parts of item tokens a..b whose slot values map one to one to those of the document."""
        ours, theirs = self.hashes[a:b], hashes[a + shift : b + shift]
        kind = np.where((self.slots[a:b] > 0) | (ours != theirs), np.maximum(self.slots[a:b], slots[a + shift : b + shift]), 0)
        there, back = {}, {}  # value -> (what it stands for, where last)
        out, first = [], a
        for at, k, x, y in zip(range(a, b), kind.tolist(), ours.tolist(), theirs.tolist(), strict=True):
            if not k:
                continue
            begin = first
            for last, value in ((there.get((k, x)), y), (back.get((k, y)), x)):
                if last and last[0] != value:
                    begin = max(begin, last[1] + 1)
            if begin > first:
                out.append((first, at))
                first = begin
            there[k, x], back[k, y] = (y, at), (x, at)
        return [*out, (first, b)]

    def chosen(self, parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The longest part, then the longest of what it leaves of the others, and so on, down to a window."""
        out = []
        while parts:
            low, high = max(parts, key=lambda p: (p[1] - p[0], -p[0]))
            if high - low < self.window:
                break
            out.append((low, high))
            left = [(a, min(b, low)) if a < low else (max(a, high), b) for a, b in parts]
            parts = [(a, b) for a, b in left if a < b]
        return out

    def verbatim(self, a: int, b: int, shift: int, hashes: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of item tokens a..b, a window long at least, that stand in the document word for word."""
        same = np.concatenate([[False], self.hashes[a:b] == hashes[a + shift : b + shift], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2) + a
        return [(low, high) for low, high in edges.tolist() if high - low >= self.window]


def _groups(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """Items in groups of bounded size, by a hash of id and text."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null").distinct()
    chars = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    count = max(1, -(-chars // (3 * GROUP_TOKENS)))
    group = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    for k in range(count):
        rows = [(r["id"], r["text"]) for r in items.where(group == k).collect()]
        if rows:
            yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _slices(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[pa.Array, pa.Array]]:
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    first, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= SLICE_BYTES or k == len(sizes) - 1:
            yield ids.slice(first, k + 1 - first), texts.slice(first, k + 1 - first)
            first, total = k + 1, 0


def leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per input row: id, contaminated, n_items, items (ids, sorted), matched_words (of the item most matched)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row long, n_items int, items array<long>, matched_words int"
    passes = []
    for items in _groups(benchmark, item_col, item_text):
        held = docs.sparkSession.sparkContext.broadcast(Benchmark(items, window))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            bench = held.value
            sizes = np.diff(bench.bounds)
            for batch in batches:
                for ids, texts in _slices(batch.column(0), batch.column(1)):
                    hashes, slots, bounds = lex(texts)
                    hit: dict[int, list[tuple[int, int]]] = defaultdict(list)
                    for (text, item), found in bench.matches(hashes, slots, bounds).items():
                        words = bench.covered(found, hashes, slots)
                        if words >= min(least_words, sizes[item]):
                            hit[text].append((item, words))
                    n = range(len(texts))
                    names = [sorted({bench.ids[i] for i, _ in hit[k] if bench.ids[i] is not None}) for k in n]
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array([len(hit[k]) for k in n], pa.int32()), pa.array(names, pa.list_(pa.int64())), pa.array([max((w for _, w in hit[k]), default=0) for k in n], pa.int32())],
                        ["doc_id", "n_items", "items", "matched_words"],
                    )

        passes.append(rows.mapInArrow(run, schema.replace("row long, ", "")))
    if not passes:
        none = F.array().cast("array<long>")
        return rows.select(F.col("doc_id").alias(id_col), F.lit(False).alias("contaminated"), F.lit(0).alias("n_items"), none.alias("items"), F.lit(0).alias("matched_words"))
    if len(passes) == 1:
        found = passes[0]
    else:  # the rows of each pass, put together by id and content
        found = _together(passes)
    return found.select(F.col("doc_id").alias(id_col), (F.col("n_items") > 0).alias("contaminated"), "n_items", "items", "matched_words")


def _together(passes: list[DataFrame]) -> DataFrame:
    """One row per document over several passes; rows of equal id are taken together and given back as often as they came."""
    every = passes[0].withColumn("pass", F.lit(0))
    for k, p in enumerate(passes[1:], 1):
        every = every.unionByName(p.withColumn("pass", F.lit(k)))
    by_id = every.groupBy("doc_id").agg(
        F.count_if(F.col("pass") == 0).alias("times"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("matched_words").alias("matched_words"),
        F.max("n_items").alias("most"),
    )
    wide = by_id.select("doc_id", F.greatest(F.size("items"), "most").alias("n_items"), "items", "matched_words", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return wide.select("doc_id", "n_items", "items", "matched_words")


def without_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, whose id no item contaminates (rows of equal id go together)."""
    found = leaks(docs, benchmark, window, least_words, id_col, text_col)
    gone = written(found.where("contaminated").select(F.col(id_col).alias("_gone_id")).distinct(), "leaks")
    return docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]), "left_anti")
