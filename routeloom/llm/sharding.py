"""Weighted rendezvous hashing of stable record keys over shards.

Every shard draws a number from the key and its own name; the record goes where
``-ln(u) / weight`` is least.  Adding a shard only adds one more draw, so a
record either stays or moves into the new shard, and with equal weights about
one in ``n + 1`` moves.

Slots number the rows of a shard without gaps.  Rows of a shard are ranked in
``buckets`` groups by a hash of the key and the groups' sizes are summed up, so
that no task holds a shard; the table of sizes has ``shards * buckets`` rows,
whatever the data.

Defined results: a null key hashes as the empty key; rows with equal keys share
a shard and are ranked by size, then checksum; a null text has size 1 and the
checksum of no bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routeloom.session import written

_HEX = 13  # hexadecimal digits that a double holds exactly


def _draw(key: Column, shard: int) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, _HEX)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_HEX)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard number for ``key`` (text) among ``len(weights)`` shards."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    return _winner(_costs(key, weights))


def _costs(key: Column, weights: Sequence[float]) -> list[Column]:
    return [F.struct((-F.ln(_draw(key, k)) / float(w)).alias("cost"), F.lit(k).alias("shard")) for k, w in enumerate(weights)]


def _winner(costs: list[Column]) -> Column:
    return F.array_min(F.array(*costs)).getField("shard")


def shard_documents(
    docs: DataFrame,
    weights: Sequence[float],
    grown_weight: float = 1.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_digits: int = 3,
) -> DataFrame:
    """One row per input row: id, size, text_crc32, shard, slot, grown_shard.

    ``weights``: of the shards 0, 1, ...; ``grown_weight``: of one shard more.
    ``bucket_digits``: hexadecimal digits of the ranking groups (16**digits a shard).
    """
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = docs.select(
        F.col(id_col).alias("id"),
        key.alias("key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    grown = [*weights, grown_weight]
    placed = placed.select(
        "id",
        "size",
        "text_crc32",
        rendezvous(F.col("key"), weights).alias("shard"),
        rendezvous(F.col("key"), grown).alias("grown_shard"),
        F.substring(F.md5("key"), 1, bucket_digits).alias("bucket"),
    )
    placed = written(placed, "shards")
    sizes = placed.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    rank = Window.partitionBy("shard", "bucket").orderBy("id", "size", "text_crc32")
    ranked = placed.withColumn("rank", F.row_number().over(rank) - 1)
    return ranked.join(F.broadcast(starts), ["shard", "bucket"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("start") + F.col("rank")).alias("slot"), "grown_shard"
    )
