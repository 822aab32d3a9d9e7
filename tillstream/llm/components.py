"""Connected components of an edge table, by star contraction.

Each round links every node to the least node of its neighbourhood, first for
the larger neighbours (large star), then for the smaller ones (small star), and
writes the edges to the shared folder. It ends when a round changes nothing:
then every node hangs on the least node of its component. A hub's edges are
read through partial aggregates and skew-split joins; no task needs them all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import materialize


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """(node, least): the least of a node and its neighbours, for both directions' rows."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))


def connected(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, label) for every node of edges (a, b): the least node that it reaches."""
    now = materialize(_ordered(edges.select("a", "b")))
    before = _mark(now)
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = both.join(_least_neighbour(both), "a")
        # large star: larger neighbours move to the least one
        large = _ordered(stars.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")))
        large = _ordered(large.unionByName(stars.filter("least < a").select("a", F.col("least").alias("b"))))
        # small star: edges point down; smaller neighbours and the node move to the least one
        down = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(down.select("a", F.col("least").alias("b")))
        now = materialize(_ordered(small))
        after = _mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges with a > b."""
    pair = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pair.filter("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Tells whether two edge tables are equal, but for a chance of 2**-64."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
