"""Chat formatting by event-sourced reconstruction.

A log has, for each conversation, events in the order of ``seq``:

* ``message``     opens a message with ``role`` and ``text``
* ``delta``       appends ``text`` to its message (streamed output)
* ``edit``        replaces the text of its message
* ``regenerate``  empties its message; deltas that follow fill it anew

``fold_events`` folds the events of each (conversation, message_id) into final
messages, so a long conversation is dealt over many tasks.  ``render`` then sorts
the messages by conversation and writes the template as a stream: a conversation
longer than ``part_chars`` comes in several parts, so no task holds one as a whole.

Template, per turn: ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``.  Inside
role and text a backslash is doubled and ``<|`` becomes ``<\\|``, so control
strings there cannot be taken for marks, and ``unescape`` undoes it exactly.

Defined results: null texts and roles are empty; events of any other kind, or
without one, change nothing; an event for a message that
was never opened opens it as ``assistant``; events with equal ``seq`` are taken
by kind (message, regenerate, edit, delta) and then by text; repeated ``message``
events are separate turns; a null conversation id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routeloom.session import ship

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPED = re.compile(r"\\(.)", re.S)

EVENT_COLUMNS = ("conv_id", "seq", "message_id", "kind", "role", "text")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, seq, role, text) of a log with ``EVENT_COLUMNS``.

    Each event belongs to the message opened last before it.  Of a message the deltas
    after its last edit or regeneration are joined in order, in one step, so the work
    grows with the length of the stream.
    """
    order = F.element_at(F.create_map(*[F.lit(x) for kv in (("message", 0), ("regenerate", 1), ("edit", 2), ("delta", 3)) for x in kv]), F.col("kind"))
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    known = events.select("conv_id", "message_id", F.col("seq").cast("long").alias("seq"), order.alias("o"), text.alias("text"), role.alias("role")).where("o is not null")
    by_time = Window.partitionBy("conv_id", "message_id").orderBy("seq", "o", "text", "role").rowsBetween(Window.unboundedPreceding, 0)
    told = known.withColumn("turn", F.count_if(F.col("o") == 0).over(by_time))
    # what is said from here on stands behind the last event that sets or empties the text
    told = told.withColumn("life", F.count_if(F.col("o") < 3).over(by_time)).withColumn("at", F.row_number().over(by_time))
    key = ["conv_id", "message_id", "turn"]
    lives = told.groupBy(*key, "life").agg(
        F.min(F.struct("at", "seq", "o", "role")).alias("first"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("o") != 1, F.struct("at", "text")))), lambda e: e["text"]), "").alias("text"),
    )
    last = lives.groupBy(*key).agg(F.min("first").alias("first"), F.max_by("text", "life").alias("text"))
    opened = F.when(F.col("first.o") == 0, F.col("first.role")).otherwise(F.lit("assistant"))
    return last.select("conv_id", F.col("first.seq").alias("seq"), opened.alias("role"), "text")


RENDERED = "part int, formatted string, loss_spans array<struct<start:long,length:long>>, ended boolean"


def render(messages: DataFrame, part_chars: int = 1_000_000, loss_role: str = "assistant") -> DataFrame:
    """Formatted conversations: conv_id, part, formatted, loss_spans, ended.

    Parts of a conversation follow each other in one partition.  ``loss_spans`` are
    (start, length) in code points of the part, over the escaped texts of ``loss_role``.
    """
    ship(messages.sparkSession)
    kind = messages.schema["conv_id"].dataType.simpleString()
    ordered = (
        messages.select("conv_id", "seq", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        out: list[tuple] = []
        current, part, pieces, spans, at, open_ = None, 0, [], [], 0, False

        def close(ended: bool):
            nonlocal pieces, spans, at, part
            out.append((current, part, "".join(pieces), spans, ended))
            pieces, spans, at, part = [], [], 0, part + 1

        def batch_of(rows):
            columns = list(zip(*rows, strict=True))
            span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            spans_ = [[{"start": a, "length": n} for a, n in s] for s in columns[3]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string()), pa.array(spans_, span), pa.array(columns[4], pa.bool_())],
                ["conv_id", "part", "formatted", "loss_spans", "ended"],
            )

        size = 0
        for batch in batches:
            id_type = batch.column(0).type
            for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if not open_ or conv != current:
                    if open_:
                        close(True)
                    current, part, open_ = conv, 0, True
                head, body = f"{START}{escape_role(role)}\n", escape(text)
                if role == loss_role:
                    spans.append((at + len(head), len(body)))
                pieces += (head, body, END, "\n")
                grown = len(head) + len(body) + len(END) + 1
                at, size = at + grown, size + grown
                if at >= part_chars:
                    close(False)
                if size >= part_chars and out:
                    yield batch_of(out)
                    out, size = [], 0
        if open_:
            close(True)
        if out:
            yield batch_of(out)

    return ordered.mapInArrow(run, f"conv_id {kind}, {RENDERED}")


def format_chat(events: DataFrame, part_chars: int = 1_000_000) -> DataFrame:
    """``fold_events``, then ``render``."""
    return render(fold_events(events), part_chars)


def parse_part(formatted: str) -> list[tuple[str, str]]:
    """(role, text) per turn of a rendered part."""
    turns = []
    for block in formatted.split(END + "\n")[:-1]:
        head, _, body = block.removeprefix(START).partition("\n")
        turns.append((unescape_role(head), unescape(body)))
    return turns


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(rendered: DataFrame) -> DataFrame:
    """Digests of what ``render`` wrote, parsed back part by part as they follow each other."""
    kind = rendered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            rows = []
            for conv, formatted, spans, ended in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4)), strict=True):
                state = state or [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse_part(formatted):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                for span in spans:
                    said = unescape(formatted[span["start"] : span["start"] + span["length"]])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(formatted)
                if ended:
                    rows.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                    state = None
            if rows:
                columns = list(zip(*rows, strict=True))
                kinds = (batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return rendered.mapInArrow(run, f"conv_id {kind}, {DIGESTS}")
