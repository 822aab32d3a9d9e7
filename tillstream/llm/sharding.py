"""Rendezvous hashing of record keys over weighted shards.

Every shard draws a number for a key; the shard with the best one, weighed by
its share, takes the key. A new shard takes only the keys that it wins, and no
key moves between the others.

The law is ``key``: a record's doc_id and the shards decide. Records without a
doc_id share one draw, so all go to the same shard; equal ids always meet.
Records of a shard are numbered from 0 by sub-shards, so that no task holds a
whole shard: counts of the sub-shards, a bounded number, give each its start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import unit_interval


def rendezvous(key: Column, weights: dict[int, float]) -> Column:
    """The shard of a key; equal draws go to the larger number."""
    draws = [
        F.struct(
            (F.lit(-float(weight)) / F.ln(unit_interval(key, f"shard-{shard}"))).alias("draw"),
            F.lit(shard).alias("shard"),
        )
        for shard, weight in weights.items()
        if weight > 0
    ]
    best = F.greatest(*draws) if len(draws) > 1 else draws[0]
    return best["shard"]


def even_weights(shards: int) -> dict[int, float]:
    return dict.fromkeys(range(shards), 1.0)


def assign_shards(
    docs: DataFrame,
    weights: dict[int, float],
    grown: dict[int, float] | None = None,
    sub_shards: int = 256,
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row.

    ``size``: UTF-8 bytes of the text (null: none) plus 1. The checksum of a null
    text is that of an empty one. ``slot`` numbers the rows of a shard by
    sub-shard, then doc_id, size and checksum. ``sub_shards`` grows with the
    number of tasks that may share a shard.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sub = F.floor(unit_interval(F.concat_ws(":", key, F.crc32(text)), "sub-shard") * sub_shards)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, grown or weights).alias("grown_shard"),
        sub.cast("int").alias("_sub"),
    )
    counts = rows.groupBy("shard", "_sub").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "shard", "_sub", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("shard", "_sub").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("_nth", F.row_number().over(within) - 1)
        .join(starts, ["shard", "_sub"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("key").alias("law"),
            "shard",
            (F.col("_start") + F.col("_nth")).alias("slot"),
            "grown_shard",
        )
    )


def write_shards(docs: DataFrame, path: str, weights: dict[int, float]) -> None:
    """The documents, in a folder for each shard."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs.withColumn("shard", rendezvous(key, weights)).write.partitionBy("shard").parquet(path)
