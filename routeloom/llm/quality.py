"""Quality scores from zstandard dictionaries of good and of bad labelled text.

A text is looked at in two views: its words as they stand, and its *shape*, in
which a word is one letter for how it is written and whether it repeats one of
the last words.  Each view has a dictionary of good and one of bad examples.  The
text is compressed in blocks with either; the normalised difference

    (bytes with the bad dictionary - bytes with the good one) / their sum

of the two views is turned into a probability by logistic calibration on labelled
rows that gave no example to a dictionary.

All of a text is compressed, block by block, so a block far down counts as the
first.  Defined results: null and empty texts have a difference of 0 in both
views; a table without labelled rows of both classes scores 0.5 throughout;
repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.llm.labelled import class_weights, fit_logistic, fold_of, sigmoid, training_rows
from routeloom.session import ship

#: Labelled rows of a class at most, half for the dictionaries, half for calibration.
SAMPLE_ROWS = 1_500
#: Bytes of a dictionary at most, and of a sample document's part in it.
DICTIONARY_BYTES, EXAMPLE_BYTES = 112_640, 1_024
#: Blocks are compressed each by itself: small enough for the dictionary to matter
#: more than what the block has in itself (a shape repeats itself at once).
BLOCK_BYTES = {"words": 1_024, "shape": 24}
LEVEL = 9

_TOKEN = re.compile(r"\S+|\n")


def shape_of(text: str) -> str:
    """The shape view: one letter a word, marks kept, line ends kept."""
    out, recent = [], ("", "", "")
    for token in _TOKEN.findall(text):
        if token == "\n":
            out.append("\n")
            continue
        if token in recent:
            out.append("=re")
        elif token.isalpha():
            out.append("a" if token.islower() else "A" if token[1:].islower() else "U" if token.isupper() and len(token) > 1 else "M")
        else:
            core = token.rstrip(".,;:!?")
            tail = token[len(core) :]
            if core.isalpha():
                out.append(("a" if core.islower() else "U" if core.isupper() and len(core) > 1 else "A") + tail)
            elif core.isdigit():
                out.append("d" + tail)
            else:
                out.append("".join("x" if c.isalpha() else "d" if c.isdigit() else c for c in token[-4:]) if token else "")
        recent = (recent[1], recent[2], token)
    return "".join(out)


@dataclass
class QualityModel:
    """Dictionaries (view -> bad, good) and calibration weights."""

    dictionaries: dict[str, tuple[bytes, bytes]]
    weights: np.ndarray | None


class _Sizer:
    def __init__(self, dictionaries: dict[str, tuple[bytes, bytes]]):
        import zstandard

        self.of = {}
        for view, pair in dictionaries.items():
            self.of[view] = []
            for raw in pair:
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self.of[view].append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, view: str, data: bytes) -> float:
        bad, good = self.of[view]
        a = b = 0
        step = BLOCK_BYTES[view]
        for at in range(0, len(data), step):
            block = data[at : at + step]
            a += len(bad.compress(block)) - 2
            b += len(good.compress(block)) - 2
        return (a - b) / (a + b) if a + b > 0 else 0.0


def views(text: str) -> tuple[bytes, bytes]:
    return text.encode("utf-8", "surrogatepass"), shape_of(text).encode("utf-8", "surrogatepass")


def differences(sizer: _Sizer, text: str) -> tuple[float, float]:
    words, shape = views(text)
    return sizer.difference("words", words), sizer.difference("shape", shape)


def _examples(rows: list[tuple[int, str]]) -> dict[str, tuple[bytes, bytes]]:
    """Raw dictionaries from (label, text) rows, as much from either class."""
    made: dict[str, tuple[bytes, bytes]] = {}
    for k, view in enumerate(("words", "shape")):
        pair = []
        for label in (0, 1):
            parts, size = [], 0
            for i, text in enumerate(t for y, t in rows if y == label):
                data = views(text)[k]
                # another place in each document, so that openings do not fill the dictionary
                at = (i * 769) % max(1, len(data) - EXAMPLE_BYTES + 1)
                parts.append(data[at : at + EXAMPLE_BYTES])
                size += len(parts[-1])
                if size >= DICTIONARY_BYTES:
                    break
            pair.append(b"\n".join(parts)[:DICTIONARY_BYTES])
        room = min(map(len, pair))
        made[view] = (pair[0][:room], pair[1][:room])
    return made


def _excerpt(text, size: int = 8 * EXAMPLE_BYTES):
    """A place in a text that a hash of it picks; only for dictionary examples."""
    room = F.greatest(F.length(text) - size, F.lit(0)) + 1
    return F.substring(text, (F.pmod(F.xxhash64(text), room) + 1).cast("int"), F.lit(size))


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Learn from at most ``sample_rows`` labelled rows of each class, half for each of the two steps."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, "quality", sample_rows, id_col, text_col)
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    first = rows.where(half == 0).select("label", _excerpt(F.col("text")).alias("text"), F.xxhash64("doc_id").alias("draw"))
    examples = sorted((r["draw"], r["label"], r["text"]) for r in first.collect())
    dictionaries = _examples([(y, t) for _, y, t in examples])
    if any(len(d) < 8 for pair in dictionaries.values() for d in pair):
        return QualityModel(dictionaries, None)
    second = _differences(rows.where(half == 1).select("doc_id", "text", "label"), dictionaries, "label").select("label", "words", "shape")
    got = np.array([tuple(r) for r in second.collect()], float).reshape(-1, 3)
    got = got[np.lexsort(got.T)]
    if len(set(got[:, 0])) < 2:
        return QualityModel(dictionaries, None)
    stands_for = class_weights(labels, "quality", sample_rows, id_col)
    weight = np.array([stands_for[int(y)] for y in got[:, 0]])
    return QualityModel(dictionaries, fit_logistic(got[:, 1:] * 10, got[:, 0], weight=weight))


def _differences(rows: DataFrame, dictionaries: dict[str, tuple[bytes, bytes]], keep: str) -> DataFrame:
    """(doc_id, keep, words, shape) for rows of (doc_id, text, keep)."""
    held = rows.sparkSession.sparkContext.broadcast(dictionaries)  # four times DICTIONARY_BYTES at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _Sizer(held.value)
        for batch in batches:
            found = [differences(sizer, x.as_py()) for x in batch.column(1)]
            parts = [pa.array([f[k] for f in found], pa.float64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *parts], ["doc_id", keep, "words", "shape"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"doc_id {kinds['doc_id']}, {keep} {kinds[keep]}, words double, shape double")


def score_quality(docs: DataFrame, model: QualityModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted, and the differences of both views."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (fold_of(id_col) == 0).alias("held_out"))
    if model.weights is None:
        found = rows.select("doc_id", "held_out", F.lit(0.0).alias("words"), F.lit(0.0).alias("shape"), F.lit(0.5).alias("score"))
    else:
        a, b, c = (float(w) for w in model.weights)
        x = F.col("words") * (10 * a) + F.col("shape") * (10 * b) + c
        found = _differences(rows, model.dictionaries, "held_out").withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), x)))))
    return found.select(F.col("doc_id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "words", "shape")


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with their columns, whose text scores at least ``threshold``."""
    ship(docs.sparkSession)
    if model.weights is None:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer, w = _Sizer(held.value.dictionaries), held.value.weights
        for batch in batches:
            found = np.array([differences(sizer, x.as_py() or "") for x in batch.column(at)]).reshape(-1, 2)
            score = sigmoid(found @ (10 * w[:2]) + w[2])
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
