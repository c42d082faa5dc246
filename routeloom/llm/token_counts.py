"""Token counts of whole texts, with overlap resynchronisation for huge ones.

A text of up to ``chunk_chars`` code points is encoded in one go.  A longer one
is cut into overlapping chunks, each encoded with offsets.  Two neighbours are
spliced at a boundary that both encodings have and that is *stable*: the code
point before it is no white space and the one after it is.  A byte-level
pre-tokenizer never has a piece that runs over such a place and looks at
nothing left of it, so the tokens on either side are those of the whole text.
As evidence that the two encodings run in step, at least two such boundaries
with equal ids between them are asked for; where there are none (one very long
word), the overlap is doubled, and at last the chunks are joined into one.

Defined results: a null text counts as empty (0 tokens); null ids stay null;
repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.session import ship

#: Tokenizers of this Python process, by path.
_LOADED: dict[str, object] = {}

#: Code points handed to the library at once; bounds the memory of encodings.
BATCH_CHARS = 400_000


def load_tokenizer(path: str):
    """The tokenizer at ``path``, loaded once in a process, on one thread."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def _stable_ends(encoding, text: str, base: int, low: int, high: int) -> dict[int, int]:
    """Absolute stable boundaries in (low, high) -> tokens of the chunk before them."""
    found = {}
    for k, (_, end) in enumerate(encoding.offsets):
        at = base + end
        if low < at < high and text[at].isspace() and not text[at - 1].isspace():
            found[at] = k + 1
    return found


def resync_count(tokenizer, text: str, chunk_chars: int, overlap_chars: int) -> tuple[int, int, int]:
    """(tokens, chunks, widenings) of one text by splicing overlapping chunks."""
    total, chunks, widened = 0, 1, 0
    begin, end = 0, min(len(text), chunk_chars)
    left = tokenizer.encode(text[begin:end], add_special_tokens=False)
    done = 0  # tokens of the left chunk that were counted before
    while end < len(text):
        overlap, spliced = overlap_chars, False
        while not spliced:
            start = max(begin, end - overlap)
            stop = min(len(text), start + chunk_chars + overlap)
            right = tokenizer.encode(text[start:stop], add_special_tokens=False)
            if start == begin:  # the overlap is the whole left chunk: it is replaced
                left, end, spliced = right, stop, True
                if stop < len(text):
                    chunk_chars *= 2
                continue
            ours = _stable_ends(left, text, begin, start, end)
            theirs = _stable_ends(right, text, start, start, end)
            common = sorted(ours.keys() & theirs.keys())
            for a, b in zip(reversed(common[:-1]), reversed(common[1:]), strict=False):
                if ours[a] >= done and left.ids[ours[a] : ours[b]] == right.ids[theirs[a] : theirs[b]]:
                    total += ours[b] - done
                    left, done, begin, end, spliced = right, theirs[b], start, stop, True
                    chunks += 1
                    break
            else:
                overlap *= 2
                widened += 1
    return total + len(left.ids) - done, chunks, widened


def _counts(tokenizer, texts: list[str], chunk_chars: int, overlap_chars: int) -> list[tuple[int, int, int]]:
    """Counts of ``texts`` in their order; short texts go to the library in batches of bounded size."""
    out: list = [None] * len(texts)
    waiting, size = [], 0

    def flush():
        for k, encoding in zip(waiting, tokenizer.encode_batch_fast([texts[k] for k in waiting], add_special_tokens=False), strict=True):
            out[k] = (len(encoding), 1, 0)

    for k, text in enumerate(texts):
        if len(text) > chunk_chars:
            out[k] = resync_count(tokenizer, text, chunk_chars, overlap_chars)
            continue
        waiting.append(k)
        size += len(text)
        if size >= BATCH_CHARS:
            flush()
            waiting, size = [], 0
    flush()
    return out


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
    chunk_chars: int = 65_536,
    overlap_chars: int = 2_048,
) -> DataFrame:
    """One row per input row: id, n_bytes, n_tokens, over_limit, n_chunks, n_widened.

    ``limit``: texts of more tokens get ``over_limit``.
    ``chunk_chars``, ``overlap_chars``: sizes in code points for huge texts.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = _counts(tokenizer, texts, chunk_chars, overlap_chars)
            sizes = pc.binary_length(batch.column(1)).cast(pa.int64())
            parts = [pa.array([x[i] for x in found], kind) for i, kind in ((0, pa.int64()), (1, pa.int32()), (2, pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, *parts], ["id", "n_bytes", "n_tokens", "n_chunks", "n_widened"])

    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, n_chunks int, n_widened int")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks", "n_widened"
    )
