"""Phrase collocations from the counts of longest windows.

Every word opens a window: the word and the ones that follow it in its piece,
side by side in lead columns and padded with nulls. Only windows are counted.
The count of a shorter phrase is the sum over the windows that begin with it,
so one ROLLUP of the windows gives all lengths at once.

A first pass, over windows of two words, counts the words and, by a number for
each, the pairs. Every pair inside a frequent phrase is frequent, so the longest
windows are cut where a pair is not, and counted from their first pair on. That
is exact: what is left out has too small a count, and pairs that share a number
are told apart when the windows are counted by their words.

A null text is empty and a null language ``und``. Rows count as often as they
stand in the table, whatever their ids; other columns are ignored. A text of any
length is cut into pieces first. An empty table gives no rows. Equal scores go
by count, then by the phrase's bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import materialize

LONGEST = 5
LEAST_COUNT = 100
TOP = 2000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_ENDS, GAPS = "[.,;:!?\\x0A-\\x0D]", "[ \\t]+"
#: Frequent pairs are told apart by so many numbers. Where pairs share one, windows
#: are counted in vain, and nothing else changes.
PAIR_BUCKETS = 1 << 22
#: Rows of a language that reach one task before the last ranking: ``TOP`` of each.
RANK_BUCKETS = 64


def pieces(docs: DataFrame) -> DataFrame:
    """lang and the words of every piece."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    return (
        docs.select(
            F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
            F.explode(F.split(text, PIECE_ENDS)).alias("piece"),
        )
        .select("lang", F.array_remove(F.split("piece", GAPS), "").alias("words"))
        .where(F.size("words") > 0)
    )


def _columns(order: int) -> list[str]:
    return [f"w{k}" for k in range(1, order + 1)]


def lead_windows(cut: DataFrame, order: int) -> DataFrame:
    """lang, w1 ... : each word and those after it in its piece, nulls behind the end."""
    words = F.col("words")
    ahead = [F.slice(words, k, F.greatest(F.size(words), F.lit(1))) for k in range(2, order + 1)]
    return cut.select("lang", F.inline(F.arrays_zip(words, *ahead)).alias(*_columns(order)))


def marginals(windows: DataFrame, order: int) -> DataFrame:
    """lang, w1 ..., size and f: how often the windows begin with the first ``size`` words.

    Size 0 is the number of windows of a language.
    """
    names = _columns(order)
    # tasks add up their windows and all prefixes before the one shuffle
    rolled = windows.rollup("lang", *names).agg(
        F.count(F.lit(1)).alias("f"), F.grouping_id().alias("level")
    )
    # level 2^k - 1: the last k columns are summed over
    size = F.lit(order) - F.log2(F.col("level") + 1).cast("int")
    rolled = rolled.withColumn("size", size).where("size >= 0").drop("level")
    last = F.element_at(F.array(*[F.col(name) for name in names]), F.col("size"))
    # a prefix that reaches into the padding is no phrase
    return rolled.where((F.col("size") == 0) | F.when(F.col("size") > 0, last).isNotNull())


def _pair(first: str, second: str) -> Column:
    """A number for two words; null where the second is padding."""
    return F.when(F.col(second).isNotNull(), F.xxhash64("lang", first, second))


def word_and_pair_counts(cut: DataFrame, least: int) -> DataFrame:
    """The written counts of languages, of frequent words, and of frequent pair numbers.

    lang, w1, pair and f: only ``lang`` is set for a total, only ``pair`` for a pair.
    """
    counts = (
        lead_windows(cut, 2)
        .select("lang", "w1", _pair("w1", "w2").alias("pair"))
        .groupingSets([["lang"], ["lang", "w1"], ["pair"]], "lang", "w1", "pair")
        .agg(F.count(F.lit(1)).alias("f"), F.grouping_id().alias("level"))
    )
    # the bits of a level are the columns that are summed over
    totals = F.col("level") == 0b011
    frequent = (F.col("f") >= least) & ((F.col("level") == 0b001) | F.col("pair").isNotNull())
    return materialize(counts.where(totals | frequent).drop("level"))


def chains(windows: DataFrame, order: int, pairs: DataFrame) -> DataFrame:
    """Windows as far as every pair in them has one of the numbers in ``pairs``.

    Others cannot be frequent. The numbers are brought down to ``PAIR_BUCKETS``
    and broadcast.
    """
    buckets = pairs.select(_bucket(F.col("pair")).alias("bucket")).distinct()
    names = _columns(order)
    kept = windows.withColumn("bucket", _bucket(_pair("w1", "w2")))
    kept = kept.join(F.broadcast(buckets), "bucket", "left_semi").drop("bucket")
    for before, name in zip(names[1:], names[2:], strict=False):
        known = buckets.select("bucket", F.lit(True).alias("known"))
        kept = kept.withColumn("bucket", _bucket(_pair(before, name)))
        kept = kept.join(F.broadcast(known), "bucket", "left").drop("bucket")
        # a window that has ended stays so: its pairs are null from there on
        kept = kept.withColumn(name, F.when(F.col("known"), F.col(name))).drop("known")
    return kept.select("lang", *names)


def _bucket(pair: Column) -> Column:
    return F.pmod(pair, F.lit(PAIR_BUCKETS))


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT
) -> tuple[DataFrame, DataFrame]:
    """(lang, n) and (lang, size, phrase, f) of every phrase counted ``least`` times.

    Both are written tables.
    """
    cut = pieces(docs)
    short = word_and_pair_counts(cut, least)
    totals = short.where("lang IS NOT NULL AND w1 IS NULL").select("lang", F.col("f").alias("n"))
    words = short.where("w1 IS NOT NULL").select(
        "lang", F.lit(1).alias("size"), F.col("w1").alias("phrase"), "f"
    )
    windows = chains(lead_windows(cut, longest), longest, short.where("pair IS NOT NULL"))
    longer = marginals(windows, longest).where((F.col("size") >= 2) & (F.col("f") >= least))
    phrases = longer.select("lang", "size", F.concat_ws(" ", *_columns(longest)).alias("phrase"), "f")
    return totals, materialize(words.unionByName(phrases))


def scored(totals: DataFrame, phrases: DataFrame) -> DataFrame:
    """Every phrase of two words or more with its weakest cut.

    Products are decimals of 38 digits: 1000 * a * n stays below that up to
    10^17 words.
    """
    parts = phrases.select("lang", "phrase", "f")
    words, k = F.split("phrase", " "), F.col("k")
    cuts = (
        phrases.where("size >= 2")
        .select("lang", "phrase", F.col("f").alias("a"), "size", words.alias("words"))
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("head", F.array_join(F.slice("words", F.lit(1), k), " "))
        .withColumn("rest", F.array_join(F.slice("words", k + 1, F.col("size") - k), " "))
    )
    heads = parts.withColumnsRenamed({"phrase": "head", "f": "l"})
    rests = parts.withColumnsRenamed({"phrase": "rest", "f": "r"})
    score = F.expr(
        "CAST((1000BD * CAST(a AS DECIMAL(18,0)) * CAST(n AS DECIMAL(18,0)))"
        " DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0))) AS BIGINT)"
    )
    return (
        cuts.join(heads, ["lang", "head"])
        .join(rests, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", score)
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    )


def contained(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, held): the largest count of a longer phrase around a phrase."""
    size = F.col("size")
    starts = F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda length: F.transform(
            F.sequence(F.lit(1), size - length + 1),
            lambda at: F.array_join(F.slice(F.col("words"), at, length), " "),
        ),
    )
    return (
        phrases.where("size >= 3")
        .withColumn("words", F.split("phrase", " "))
        .select("lang", "f", F.explode(F.flatten(starts)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("held"))
    )


def top_by_language(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language, ranked from 1.

    Buckets are ranked first, so the task of a language gets at most ``top``
    rows of each bucket.
    """
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS))
    within = Window.partitionBy("lang", "bucket").orderBy(*best)
    heads = (
        rows.withColumn("bucket", bucket)
        .withColumn("place", F.row_number().over(within))
        .where(F.col("place") <= top)
        .drop("bucket", "place")
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = heads.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.withColumn("rank", F.col("rank").cast("long"))


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST_COUNT, top: int = TOP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's best phrases.

    A phrase goes if a longer one around it is at least as frequent.
    """
    totals, phrases = frequent_phrases(docs, longest, least)
    kept = (
        scored(totals, phrases)
        .join(contained(phrases), ["lang", "phrase"], "left")
        .where(F.coalesce(F.col("held"), F.lit(0)) < F.col("a"))
    )
    return top_by_language(kept, top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
