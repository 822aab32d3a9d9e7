"""Bisecting k-means for several k at once.

Spark ML's method with its random numbers, its order of clusters and its 20
rounds a level: the models are those of ``BisectingKMeans(k, seed)``. Trees of
all k are the same down to the last level of the smaller one, so a level is
split once for all of them. Where a k has too few clusters left to split
them all, it splits the largest; those splits run in the same scans.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext, cloudpickle
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import DenseVector

from tillstream.plans.passes import Blocks, cluster_sums, squared_gap

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROUNDS = 20
ROOT = 1
# Fixed values of Spark ML: the deepest level, and the cost that a row of a
# cluster worth splitting exceeds on average.
LEVEL_LIMIT = 63
EPSILON = 2.0**-52


@dataclass
class Node:
    """A cluster: rows, center, the cost training sees, and that to the final center."""

    size: int
    center: np.ndarray
    cost: float
    final_cost: float = 0.0


# A split is a cluster and the place its random numbers have in its level.
Split = tuple[int, int]
Clusters = dict[int, Node]


class Orders:
    """The orders in which the collections of Spark ML's solver list clusters.

    Random numbers are drawn in these orders. The collections themselves are asked.
    """

    def __init__(self, context: SparkContext, partitions: int):
        self.jvm, self.partitions = context._jvm, partitions

    def hashed(self, keys: Iterable[int]) -> list[int]:
        """Of an immutable map of more than four clusters."""
        given = self.jvm.java.util.LinkedHashMap()
        for key in keys:
            given.put(key, key)
        found = self.jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(given)
        return [int(key) for key in found.keys().mkString(",").split(",")]

    def collected(self, keys: Sequence[int]) -> list[int]:
        """Of clusters that come from a shuffle: smaller maps list them as they come."""
        if len(keys) > 4:
            return self.hashed(keys)
        order = []
        for part in sorted({key % self.partitions for key in keys}):
            slots = self.jvm.org.apache.spark.util.collection.AppendOnlyMap(64)
            for key in keys:
                if key % self.partitions == part:
                    slots.update(key, key)
            found = slots.iterator()
            while found.hasNext():
                order.append(int(found.next()._1()))
        return order


@dataclass
class Level:
    """Half-spaces that send the rows of each cluster to one of its two children."""

    weights: np.ndarray
    limits: np.ndarray
    children: np.ndarray

    def step(self, x: np.ndarray, place: np.ndarray) -> np.ndarray:
        along = np.einsum("dn,dn->n", x, self.weights.take(place, axis=1))
        return self.children.take(2 * place + (along > self.limits.take(place)))


def _level(count: int, width: int, splits: dict[int, tuple], children: dict[int, int]) -> Level:
    """The step of ``count`` numbered clusters; the others stay in ``children``."""
    weights, limits = np.zeros((width, count)), np.full(count, np.inf)
    sides = np.array([[children.get(place, 0)] * 2 for place in range(count)], dtype=np.intp)
    for place, (centers, numbers) in splits.items():
        sides[place] = numbers
        if centers[0] is None or centers[1] is None:
            # Spark drops a child that lost its rows
            limits[place] = -np.inf if centers[0] is None else np.inf
        else:
            weights[:, place] = centers[1] - centers[0]
            limits[place] = (centers[0] + centers[1]) @ weights[:, place] / 2
    return Level(weights, limits, sides.ravel())


class _Fit:
    """The tree all k share, grown level by level."""

    def __init__(self, blocks: Blocks, seed: int):
        self.blocks = blocks
        context = blocks.context
        self.random = context._jvm.java.util.Random(seed)
        given = context.getConf().contains("spark.default.parallelism")
        parts = blocks.rows._jdf.rdd().getNumPartitions()
        self.orders = Orders(context, context.defaultParallelism if given else parts)
        self.levels: list[Level] = []
        # clusters rows may be in after the levels so far, by their number
        self.places = [ROOT]
        sums = blocks.add_up(
            lambda x: cluster_sums(
                x, np.zeros(x.shape[1], np.intp), 1, np.einsum("dn,dn->n", x, x)
            )
        )
        self.root = _node(sums[:, 0])

    def chosen(self, divisible: Sequence[int], clusters: Clusters, needed: int) -> list[int]:
        """The clusters to split: all, or the largest where a k needs fewer."""
        if len(divisible) <= needed:
            return list(divisible)
        largest = sorted(divisible, key=lambda index: -clusters[index].size)[:needed]
        return largest if needed <= 4 else self.orders.hashed(largest)

    def draw(self, places: int) -> np.ndarray:
        width = len(self.root.center)
        drawn = [self.random.nextDouble() for _ in range(places * width)]
        return np.array(drawn).reshape(places, width)

    def halves(self, splits: Sequence[Split], clusters: Clusters) -> dict[Split, list]:
        """Both children of each split after the last round, None for one without rows."""
        noise = self.draw(max(place for _, place in splits) + 1)
        centers = {}
        for index, place in splits:
            center = clusters[index].center
            shift = 1e-4 * np.sqrt(center @ center) * noise[place]
            centers[index, place] = [center - shift, center + shift]
        families = _families(splits)
        for _ in range(ROUNDS):
            halves = self.scan(families, centers)
            found = {
                split: [None if node is None else node.center for node in pair]
                for split, pair in halves.items()
            }
            if all(_same(found[split], centers[split]) for split in splits):
                break  # the rounds left would repeat this one
            centers = found
        costs = self.scan(families, centers, halves)
        for split, pair in halves.items():
            for node, cost in zip(pair, costs[split]):
                if node is not None:
                    node.final_cost = cost
        return halves

    def scan(self, families, centers, final=None) -> dict[Split, list]:
        """One scan: children with these centers, or with ``final`` the costs of theirs."""
        numbers = {index: number for number, index in enumerate(self.places)}
        before, steps, targets, sizes = list(self.levels), [], [], []
        count, width = len(self.places), len(self.root.center)
        for family in families:
            splits, target = {}, np.zeros((width, 2 * len(family) + 1))
            for number, split in enumerate(family):
                splits[numbers[split[0]]] = (centers[split], (2 * number, 2 * number + 1))
                for side, center in enumerate(centers[split]):
                    if center is not None:
                        target[:, 2 * number + side] = center
            rest = dict.fromkeys(range(count), 2 * len(family))
            steps.append(_level(count, width, splits, rest))
            targets.append(target)
            sizes.append(2 * len(family) + 1)
        costing = final is not None

        def work(x: np.ndarray) -> np.ndarray:
            place = np.zeros(x.shape[1], dtype=np.intp)
            squares = np.einsum("dn,dn->n", x, x)
            for level in before:
                place = level.step(x, place)
            parts = []
            for step, target, size in zip(steps, targets, sizes):
                side = step.step(x, place)
                if costing:
                    gaps = squared_gap(x, target.take(side, axis=1))
                    parts.append(np.bincount(side, weights=gaps, minlength=size)[None])
                else:
                    parts.append(cluster_sums(x, side, size, squares))
            return np.concatenate(parts, axis=1)

        sums, start, found = self.blocks.add_up(work), 0, {}
        for family, size in zip(families, sizes):
            for number, split in enumerate(family):
                pair = [sums[:, start + 2 * number + side] for side in range(2)]
                found[split] = [float(s[0]) if costing else _node(s) for s in pair]
            start += size
        return found

    def descend(self, halves: dict[Split, list]) -> None:
        """Let rows go on to the children of these splits."""
        count, width = len(self.places), len(self.root.center)
        numbers = {index: number for number, index in enumerate(self.places)}
        places, splits, stay = [], {}, {}
        split_indices = {index for index, _ in halves}
        for index in self.places:
            if index not in split_indices:
                stay[numbers[index]] = len(places)
                places.append(index)
        for (index, _), pair in halves.items():
            centers = [None if node is None else node.center for node in pair]
            splits[numbers[index]] = (centers, (len(places), len(places) + 1))
            places += [2 * index, 2 * index + 1]
        self.levels.append(_level(count, width, splits, stay))
        self.places = places


def _node(sums: np.ndarray) -> Node | None:
    """The cluster of a line of sums; its cost the way Spark ML works it out."""
    size = int(sums[0])
    if not size:
        return None
    center = sums[1:-1] * (1.0 / size)
    norm = np.linalg.norm(center)
    return Node(size, center, max(float(sums[-1] - norm * norm * size), 0.0))


def _same(one: list, other: list) -> bool:
    return all(
        (a is None and b is None)
        or (a is not None and b is not None and np.array_equal(a, b))
        for a, b in zip(one, other)
    )


def _families(splits: Sequence[Split]) -> list[list[Split]]:
    """Splits in groups in which no cluster comes twice."""
    by_cluster: dict[int, list[Split]] = {}
    for split in splits:
        by_cluster.setdefault(split[0], []).append(split)
    most = max(len(same) for same in by_cluster.values())
    return [[s[turn] for s in by_cluster.values() if turn < len(s)] for turn in range(most)]


def _children(halves: dict[Split, list]) -> Clusters:
    return {
        2 * index + side: node
        for (index, _), pair in halves.items()
        for side, node in enumerate(pair)
        if node is not None
    }


def grow(blocks: Blocks, ks: Iterable[int], seed: int) -> dict[int, Clusters]:
    """The tree of each k by the numbers of its clusters: 1, and 2i and 2i + 1 below i."""
    fit = _Fit(blocks, seed)
    trees: dict[int, Clusters] = {}
    kept: Clusters = {ROOT: fit.root}
    active = [ROOT]
    open_ks, leaves = sorted(set(ks)), 1
    for _ in range(1, LEVEL_LIMIT):
        divisible = [i for i in active if kept[i].cost > EPSILON * kept[i].size]
        if not divisible or not open_ks:
            break
        chosen = {k: fit.chosen(divisible, kept, k - leaves) for k in open_ks}
        wanted = {k: [(i, place) for place, i in enumerate(chosen[k])] for k in open_ks}
        halves = fit.halves(list(dict.fromkeys(s for k in open_ks for s in wanted[k])), kept)
        for k in open_ks:
            if k - leaves <= len(divisible):
                trees[k] = kept | _children({split: halves[split] for split in wanted[k]})
        open_ks = [k for k in open_ks if k - leaves > len(divisible)]
        if not open_ks:
            break
        shared = {split: halves[split] for split in wanted[open_ks[0]]}
        children = _children(shared)
        kept = kept | children
        active = fit.orders.collected(list(children))
        leaves += len(divisible)
        fit.descend(shared)
    return trees | dict.fromkeys(open_ks, kept)


def leaf_cost(tree: Clusters, index: int = ROOT) -> float:
    """Sum of squared distances to the final centers of the leaves below a cluster."""
    if 2 * index not in tree:
        return tree[index].final_cost
    below = [child for child in (2 * index, 2 * index + 1) if child in tree]
    return sum(leaf_cost(tree, child) for child in below)


def spark_model(
    context: SparkContext, tree: Clusters, k: int, seed: int
) -> BisectingKMeansModel:
    """The Spark ML model of a tree."""
    gateway, mllib = context._gateway, context._jvm.org.apache.spark.mllib.clustering
    numbers = {"leaf": 0, "inner": -1}

    def build(index: int):
        node = tree[index]
        inner = 2 * index in tree
        kind = "inner" if inner else "leaf"
        number = numbers[kind]
        numbers[kind] += -1 if inner else 1
        below = [c for c in (2 * index, 2 * index + 1) if c in tree] if inner else []
        gaps = [float(np.linalg.norm(node.center - tree[child].center)) for child in below]
        built = [build(child) for child in below]
        children = gateway.new_array(mllib.ClusteringTreeNode, len(built))
        for place, (child, _) in enumerate(built):
            children[place] = child
        cost = sum(part for _, part in built) if inner else node.cost
        center = mllib.VectorWithNorm(_py2java(context, DenseVector(node.center)))
        made = mllib.ClusteringTreeNode(
            number, node.size, center, node.cost, max(gaps, default=0.0), children
        )
        return made, cost

    root, cost = build(ROOT)
    trained = mllib.BisectingKMeansModel(root, "euclidean", cost)
    estimator = BisectingKMeans(k=k, seed=seed)
    model = context._jvm.org.apache.spark.ml.clustering.BisectingKMeansModel(
        estimator.uid, trained
    )
    return estimator._copyValues(estimator._create_model(model))
