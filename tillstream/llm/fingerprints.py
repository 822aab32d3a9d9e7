"""Document fingerprints as threshold-scaled sketches.

A sketch keeps every five-word shingle hash below a fixed share of the hash
range. The share does not depend on the document, so sketches of any lengths
compare directly, the union of two sketches is the sketch of both documents
together, and shared hashes estimate containment even between very unequal
documents. Everything is column expressions.

Words lie between ASCII white space. A text of fewer than five words has one
shingle, all its words; a null or empty text, or one of white space, has none.
A sketch can be empty; an empty sketch is like another (1.0) only for equal
texts, and unlike (0.0) otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import task_count, text_bytes

SHINGLE = 5
#: One in so many hashes is kept.
SCALE = 4
_LEAST = -(1 << 63)


def sketch(text: Column, scale: int = SCALE) -> Column:
    """Sorted distinct kept hashes, counted from the start of the hash range."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\x09-\\x0D]+"), "")
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return _kept(hashes, scale)


def _kept(hashes: Column, scale: int) -> Column:
    limit = F.lit(_LEAST + (1 << 64) // scale)
    # one column for the hashes, so that they are not made anew for each use
    shingles = F.transform(
        F.array(hashes),
        lambda own: F.when(
            F.size(own) >= SHINGLE,
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(own) - SHINGLE + 1, F.lit(1))),
                lambda at: F.xxhash64(F.slice(own, at, SHINGLE)),
            ),
        )
        .when(F.size(own) > 0, F.array(F.xxhash64(own)))
        .otherwise(F.array().cast("array<bigint>")),
    )[0]
    kept = F.filter(shingles, lambda value: value < limit)
    return F.array_sort(
        F.array_distinct(F.transform(kept, lambda value: value.bitwiseXOR(F.lit(_LEAST))))
    )


def as_text(own: Column) -> Column:
    """A sketch as hexadecimal numbers with spaces between."""
    return F.array_join(F.transform(own, lambda value: F.lower(F.hex(value))), " ")


def from_text(fingerprint: Column) -> Column:
    """The sketch that ``as_text`` has written."""
    parts = F.array_remove(F.split(fingerprint, " "), "")
    return F.transform(parts, lambda part: F.conv(part, 16, 10).cast("bigint"))


def merge(first: Column, second: Column) -> Column:
    """The sketch of two documents together."""
    return F.array_sort(F.array_union(first, second))


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of the part's shingles found in the whole; null for an empty part."""
    return F.try_divide(F.size(F.array_intersect(part, whole)), F.size(part))


def likeness(first: Column, second: Column, equal: Column) -> Column:
    """The larger of the two containments; ``equal``: whether the texts are equal."""
    least = F.least(F.size(first), F.size(second))
    shared = F.size(F.array_intersect(first, second))
    return F.when(equal, 1.0).when(least == 0, 0.0).otherwise(shared / least)


def with_next(docs: DataFrame, columns: list[str], block_bytes: int = 4 << 20) -> DataFrame:
    """``columns`` of the next document by descending doc_id, as ``next_...``.

    After the last document comes the first. Equal ids go by text, rows without
    an id come last. Documents are dealt out once, in blocks of consecutive ids;
    the first rows of a block are also given to the block before it. The driver
    sees one id for each block.
    """
    blocks = task_count(text_bytes(docs), block_bytes)
    firsts = (
        docs.select("doc_id")
        .filter("doc_id IS NOT NULL")
        .repartitionByRange(blocks, F.desc("doc_id"))
        .groupBy(F.spark_partition_id().alias("block"))
        .agg(F.max("doc_id").alias("first"))
    )
    bounds = sorted((row["first"] for row in firsts.collect()), reverse=True)
    rows = docs.select("*", F.lit(0).alias("_ahead"), _block(bounds).alias("_block"))
    if bounds:
        before = [len(bounds) - 1, *range(len(bounds) - 1)]
        starts = F.create_map(*[F.lit(x) for pair in zip(bounds, before, strict=True) for x in pair])
        here = F.struct(F.lit(0).alias("ahead"), F.col("_block").alias("block"))
        ahead = F.struct(F.lit(1).alias("ahead"), F.try_element_at(starts, "doc_id").alias("block"))
        is_first = F.col("doc_id") == F.get(F.lit(bounds), F.col("_block"))
        places = F.when(is_first, F.array(here, ahead)).otherwise(F.array(here))
        rows = rows.withColumn("_place", F.explode(places)).withColumns(
            {"_ahead": F.col("_place.ahead"), "_block": F.col("_place.block")}
        )
    order = Window.partitionBy("_block").orderBy(
        "_ahead", F.desc_nulls_last("doc_id"), F.xxhash64("text")
    )
    following = {
        f"next_{name}": F.coalesce(F.lead(name).over(order), F.col(name)) for name in columns
    }
    return rows.withColumns(following).filter("_ahead = 0").drop("_ahead", "_block", "_place")


def _block(bounds: list[int]) -> Column:
    """The last block whose first id is not below the row's; two short searches."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    coarse = F.lit(bounds[::step])
    fine = F.array(*[F.lit(bounds[at : at + step]) for at in range(0, len(bounds), step)])
    not_below = lambda values: F.size(F.filter(values, lambda x: x >= F.col("doc_id")))
    group = F.greatest(not_below(coarse), F.lit(1)) - 1
    found = group * step + F.greatest(not_below(fine[group]), F.lit(1)) - 1
    return F.when(F.col("doc_id").isNull(), len(bounds) - 1).otherwise(found)


def compare_edited(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness.

    Edited: the last third of the code points gives way to the first as many
    (or all) of the next document.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("sketch", sketch(F.col("text"), scale))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - third),
        F.substring("next_text", F.lit(1), third),
    )
    rows = with_next(own, ["text", "sketch"]).withColumn("edited", edited)
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), scale))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch"), F.col("text") == F.col("edited")).alias(
            "near_edited"
        ),
        likeness(F.col("sketch"), F.col("next_sketch"), F.col("text") == F.col("next_text")).alias(
            "near_next"
        ),
    )
