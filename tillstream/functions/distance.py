"""Squared Euclidean distances to centroids held in the plan as literals.

A model has at most a few dozen centroids of five numbers, so they travel as
literals and every expression stays plain arithmetic inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

Center = Sequence[float]


def squared_distance(features: Sequence[Column], center: Center) -> Column:
    """Distance to one literal centroid."""
    terms = [(f - F.lit(float(c))) * (f - F.lit(float(c))) for f, c in zip(features, center)]
    return reduce(add, terms)


def assigned_distance(
    features: Sequence[Column], centers: Sequence[Center], prediction: Column
) -> Column:
    """Distance to the centroid a model assigned, which need not be the nearest."""
    terms = []
    for position, feature in enumerate(features):
        axis = F.array(*[F.lit(float(center[position])) for center in centers])
        gap = feature - F.get(axis, prediction)
        terms.append(gap * gap)
    return reduce(add, terms)


def nearest_distance(features: Sequence[Column], centers: Sequence[Center]) -> Column:
    """Smallest distance to any of the literal centroids."""
    distances = [squared_distance(features, center) for center in centers]
    return distances[0] if len(distances) == 1 else F.least(*distances)


def nearest_center(features: Sequence[Column], centers: Sequence[Center]) -> Column:
    """Index of the nearest literal centroid, the lowest index on a tie."""
    distances = [squared_distance(features, center) for center in centers]
    if len(distances) == 1:
        return F.lit(0)
    best = F.least(*distances)
    index = F.lit(len(distances) - 1)
    for position in range(len(distances) - 2, -1, -1):
        index = F.when(distances[position] == best, F.lit(position)).otherwise(index)
    return index
