"""Distances, costs, elbow selection and the anomaly threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions import distance
from tillstream.functions.distance import Center
from tillstream.schema import FEATURE_COLUMNS

ELBOW_RATIO = 0.7
THRESHOLD_RANK = 2000


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(name).cast("double") for name in names]


def score_literal(
    rows: DataFrame, centers: Sequence[Center], features: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """Add the nearest literal centroid and the squared distance to it."""
    columns = _columns(features)
    return rows.withColumn("prediction", distance.nearest_center(columns, centers)).withColumn(
        "distance", distance.nearest_distance(columns, centers)
    )


def with_assigned_distance(
    scored: DataFrame, centers: Sequence[Center], features: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """Add the squared distance to the centroid in ``prediction``."""
    return scored.withColumn(
        "distance",
        distance.assigned_distance(_columns(features), centers, F.col("prediction")),
    )


def clustering_cost(scored: DataFrame) -> DataFrame:
    """Sum of the squared distances, as one row."""
    return scored.agg(F.sum("distance").alias("cost"))


def single_cluster(rows: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """One-row model of k = 1: the feature means and the cost, in one pass."""
    cost = sum((F.var_pop(name) * F.count(name) for name in features), F.lit(0.0))
    return rows.agg(*[F.avg(name).alias(name) for name in features], cost.alias("cost"))


def codebook_costs(
    rows: DataFrame, centers: Sequence[Center], features: Sequence[str] = FEATURE_COLUMNS
) -> DataFrame:
    """(k, cost) of the nested models made of the first k literal centroids.

    All costs come out of one pass over the rows.
    """
    columns = _columns(features)
    sums = rows.agg(
        *[
            F.sum(distance.nearest_distance(columns, centers[:k])).alias(f"k{k}")
            for k in range(1, len(centers) + 1)
        ]
    )
    pairs = [
        F.struct(F.lit(k).alias("k"), F.col(f"k{k}").alias("cost"))
        for k in range(1, len(centers) + 1)
    ]
    return sums.select(F.inline(F.array(*pairs)))


def elbow_table(costs: DataFrame, ratio: float = ELBOW_RATIO) -> DataFrame:
    """One-row ``k``: the first whose cost exceeds ``ratio`` times the one before.

    The answer is 1 when no cost does. ``costs`` has one row per k of a sweep.
    """
    before = F.lag("cost").over(Window.orderBy("k"))
    qualifies = F.col("cost") > F.lit(ratio) * F.col("before")
    return costs.withColumn("before", before).agg(
        F.coalesce(F.min(F.when(qualifies, F.col("k"))), F.lit(1)).alias("k")
    )


def elbow_from_costs(costs: Sequence[float], ratio: float = ELBOW_RATIO) -> int | None:
    """The same rule on the costs of k = 1, 2, ...; None when no k qualifies yet."""
    for k in range(2, len(costs) + 1):
        if costs[k - 1] > ratio * costs[k - 2]:
            return k
    return None


def distance_threshold(scored: DataFrame, rank: int = THRESHOLD_RANK) -> DataFrame:
    """One-row ``threshold``: the rank-th largest distance, or the smallest of fewer.

    Each task keeps only its ``rank`` largest. No rows in gives NULL.
    """
    return (
        scored.select("distance")
        .orderBy(F.desc("distance"))
        .limit(rank)
        .agg(F.min("distance").alias("threshold"))
    )


def anomalies(scored: DataFrame, threshold: float | DataFrame) -> DataFrame:
    """Rows strictly further from their centroid than the threshold.

    The threshold is a number or the one-row table of ``distance_threshold``.
    """
    limit = threshold.scalar() if isinstance(threshold, DataFrame) else F.lit(float(threshold))
    return scored.where(F.col("distance") > limit)
