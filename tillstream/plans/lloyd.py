"""k-means for several k at once.

Spark ML's method with its random numbers: the models are those of
``KMeans(k, seed)``. Candidates of all k are drawn in the same scans, and a
round of Lloyd's algorithm is one scan for every k that has not converged.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
from pyspark import SparkContext, cloudpickle
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.mllib.common import _java2py, _py2java
from pyspark.mllib.linalg import DenseVector

from tillstream.plans.passes import Blocks, cluster_sums, squared_gap
from tillstream.plans.xorshift import Doubles, next_int

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Spark ML's rounds, steps of k-means||, rounds of its local k-means++ and tolerance.
ROUNDS = 20
LOCAL_ROUNDS = 30
TOLERANCE = 1e-4

Centers = dict[int, np.ndarray]


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Number of the nearest center of each row, the lowest on a tie."""
    score = centers @ x
    score -= np.einsum("kd,kd->k", centers, centers)[:, None] / 2
    best, place = score[0], np.zeros(x.shape[1], dtype=np.int16)
    for number in range(1, len(centers)):
        np.copyto(place, number, where=score[number] > best)
        np.maximum(best, score[number], out=best)
    return place


def _costs(x: np.ndarray, first: np.ndarray, added: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Squared distance to the nearest center so far, for each k in turn.

    Each k has the centers of the smaller ones and those ``added`` for it.
    """
    costs = [squared_gap(x, first[:, None])]
    for centers in added:
        cost = costs[-1]
        for center in centers:
            cost = np.minimum(cost, squared_gap(x, center[:, None]))
        costs.append(cost)
    return costs[1:]


def _sums(blocks: Blocks, first: np.ndarray, added: Sequence[np.ndarray]) -> np.ndarray:
    return blocks.add_up(lambda x: np.array([c.sum() for c in _costs(x, first, added)]))


def _drawn(
    blocks: Blocks,
    seed: int,
    step: int,
    ks: Sequence[int],
    first: np.ndarray,
    added: Sequence[np.ndarray],
) -> list[list[np.ndarray]]:
    """The rows each k draws in a step, with a chance in proportion to their cost."""
    sums = _sums(blocks, first, added)

    def work(part: int, arrays):
        chances = Doubles(seed ^ step << 16 ^ part)
        for x in arrays:
            drawn = chances.take(x.shape[1])
            costs = _costs(x, first, added)
            with np.errstate(invalid="ignore", divide="ignore"):
                taken = np.stack([drawn < 2.0 * c * k / s for c, k, s in zip(costs, ks, sums)])
            some = taken.any(axis=0)
            if some.any():
                yield x[:, some].T, taken[:, some]

    found = blocks.gather(work)
    return [
        [row for rows, taken in found for row in rows[taken[turn]]] for turn in range(len(ks))
    ]


def _first_row(blocks: Blocks, seed: int) -> np.ndarray:
    sample = blocks.rows._jdf.toJavaRDD().takeSample(False, 1, seed)
    if not len(sample):
        raise ValueError("no invoices to train on")
    return np.array([sample[0].getDouble(place) for place in range(sample[0].length())])


def start(blocks: Blocks, ks: Sequence[int], seed: int) -> Centers:
    """The centers Lloyd's algorithm starts from, by k-means|| of two steps."""
    seed = next_int(seed)
    first = _first_row(blocks, seed)
    nothing = [np.empty((0, len(first)))] * len(ks)
    once = _drawn(blocks, seed, 0, ks, first, nothing)
    # a row drawn for one k is drawn for all larger ones
    added, known = [], set()
    for rows in once:
        added.append([row for row in rows if tuple(row) not in known])
        known |= {tuple(row) for row in rows}
    twice = _drawn(blocks, seed, 1, ks, first, added)
    candidates = {
        k: np.array(list(dict.fromkeys(map(tuple, [first, *once[turn], *twice[turn]]))))
        for turn, k in enumerate(ks)
    }
    many = [k for k in ks if len(candidates[k]) > k]
    if not many:
        return candidates
    weighed = [candidates[k] for k in many]
    weights = blocks.add_up(
        lambda x: np.concatenate(
            [np.bincount(nearest(x, rows), minlength=len(rows)) for rows in weighed]
        )
    )
    ends = np.cumsum([len(rows) for rows in weighed])[:-1]
    for k, counts in zip(many, np.split(weights, ends)):
        candidates[k] = _local_start(blocks.context, candidates[k], counts, k)
    return candidates


def _local_start(
    context: SparkContext, rows: np.ndarray, weights: np.ndarray, k: int
) -> np.ndarray:
    """k of the weighted candidates by Spark's own k-means++."""
    gateway, mllib = context._gateway, context._jvm.org.apache.spark.mllib.clustering
    points = gateway.new_array(mllib.VectorWithNorm, len(rows))
    counts = gateway.new_array(gateway.jvm.double, len(rows))
    for place, (row, weight) in enumerate(zip(rows, weights)):
        points[place] = mllib.VectorWithNorm(_py2java(context, DenseVector(row)))
        counts[place] = float(weight)
    found = mllib.LocalKMeans.kMeansPlusPlus(0, points, counts, k, LOCAL_ROUNDS)
    return np.array([_java2py(context, point.vector()).toArray() for point in found])


def fit(blocks: Blocks, ks: Sequence[int], seed: int) -> Centers:
    """The centers of each k."""
    ks = sorted(ks)
    centers = start(blocks, ks, seed)
    moving = list(ks)
    for _ in range(ROUNDS):
        if not moving:
            break
        given = [centers[k] for k in moving]
        sums = blocks.add_up(
            lambda x: np.concatenate(
                [cluster_sums(x, nearest(x, c), len(c)) for c in given], axis=1
            )
        )
        ends = np.cumsum([len(c) for c in given])[:-1]
        still = []
        for k, (counts, *totals) in zip(moving, np.split(sums, ends, axis=1)):
            some = counts > 0
            after = centers[k].copy()
            after[some] = (np.array(totals)[:, some] * (1.0 / counts[some])).T
            # a center without rows stays where it is
            moved = np.einsum("kd,kd->k", after - centers[k], after - centers[k])
            if (moved > TOLERANCE * TOLERANCE).any():
                still.append(k)
            centers[k] = after
        moving = still
    return centers


def costs(blocks: Blocks, centers: Sequence[np.ndarray]) -> list[float]:
    """Each model's sum of squared distances to the nearest center, in one scan."""
    given = list(centers)

    def work(x: np.ndarray) -> np.ndarray:
        return np.array([squared_gap(x, c.T.take(nearest(x, c), axis=1)).sum() for c in given])

    return [float(cost) for cost in blocks.add_up(work)]


def spark_model(context: SparkContext, centers: np.ndarray, k: int, seed: int) -> KMeansModel:
    """The Spark ML model of these centers."""
    rows = _py2java(context, [DenseVector(center) for center in centers])
    trained = context._jvm.org.apache.spark.mllib.clustering.KMeansModel(rows)
    estimator = KMeans(k=k, seed=seed)
    model = context._jvm.org.apache.spark.ml.clustering.KMeansModel(estimator.uid, trained)
    return estimator._copyValues(estimator._create_model(model))
