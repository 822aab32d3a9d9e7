"""Fitted cluster models: assigning invoices, saving and loading."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.clustering import (
    BisectingKMeans,
    BisectingKMeansModel,
    KMeans,
    KMeansModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.distance import assigned_distance
from tillstream.operators.clusters import score_literal, with_assigned_distance
from tillstream.operators.features import assemble
from tillstream.plans import bisecting, lloyd
from tillstream.plans.passes import Blocks
from tillstream.schema import FEATURE_COLUMNS

# The names a job is started with.
KMEANS = "kMeans"
BISECTING_KMEANS = "BisKMeans"

_ESTIMATORS = {KMEANS: KMeans, BISECTING_KMEANS: BisectingKMeans}
_LOADERS = {KMEANS: KMeansModel, BISECTING_KMEANS: BisectingKMeansModel}


def check_family(family: str) -> str:
    if family not in _ESTIMATORS:
        raise ValueError(f"unknown model type {family!r}, expected {KMEANS} or {BISECTING_KMEANS}")
    return family


@dataclass
class ClusterModel:
    """A fitted Spark ML model, or plain centroids that rows are nearest to.

    The k = 1 model of a sweep is one plain centroid, the mean.
    """

    family: str
    centers: list[list[float]]
    fitted: KMeansModel | BisectingKMeansModel | None = None

    @property
    def k(self) -> int:
        return len(self.centers)

    def score(self, rows: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
        """Add the assigned cluster and the squared distance to its centroid.

        Works on batches and streams. The model's own assignment is used: a
        bisecting model descends its tree and may not pick the nearest one.
        """
        if self.fitted is None:
            return score_literal(rows, self.centers, features).drop("features")
        vectors = rows if "features" in rows.columns else assemble(rows, list(features))
        assigned = self.fitted.transform(vectors)
        return with_assigned_distance(assigned, self.centers, features).drop("features")


def fit(vectors: DataFrame, family: str, k: int, seed: int) -> ClusterModel:
    """Fit k >= 2 clusters on the ``features`` column.

    Spark ML keeps the vectors it works on only if the table it is given is not
    itself cached; of a cached one it decodes every row again in every pass.
    """
    own = vectors.select("features")
    fitted = _ESTIMATORS[check_family(family)](k=k, seed=seed).fit(own)
    return ClusterModel(family, [c.tolist() for c in fitted.clusterCenters()], fitted)


def fit_all(
    blocks: Blocks, family: str, ks: Sequence[int], seed: int
) -> tuple[list[ClusterModel], list[float]]:
    """The models of ``fit`` for several k >= 2, with their costs.

    All of them are fitted and costed in the same scans.
    """
    if check_family(family) == BISECTING_KMEANS:
        trees = bisecting.grow(blocks, ks, seed)
        fitted = [bisecting.spark_model(blocks.context, trees[k], k, seed) for k in ks]
        found = [bisecting.leaf_cost(trees[k]) for k in ks]
    else:
        centers = lloyd.fit(blocks, ks, seed)
        fitted = [lloyd.spark_model(blocks.context, centers[k], k, seed) for k in ks]
        found = lloyd.costs(blocks, [centers[k] for k in ks])
    wave = [ClusterModel(family, [c.tolist() for c in m.clusterCenters()], m) for m in fitted]
    return wave, found


def costs(vectors: DataFrame, fitted: Sequence[ClusterModel]) -> list[float]:
    """Each model's sum of squared distances to the assigned centroids, in one scan.

    Every model adds its own assignment to the rows, and one aggregate sums them all.
    """
    rows = vectors
    for place, model in enumerate(fitted):
        # a copy of the model, so that its own column name stays
        rows = model.fitted.copy({model.fitted.predictionCol: f"p{place}"}).transform(rows)
    features = [F.col(name).cast("double") for name in FEATURE_COLUMNS]
    sums = [
        F.sum(assigned_distance(features, model.centers, F.col(f"p{place}"))).alias(f"c{place}")
        for place, model in enumerate(fitted)
    ]
    return list(rows.agg(*sums).first()) if sums else []


def save_model(spark: SparkSession, model: ClusterModel, path: str) -> None:
    """Replace the model folder; plain centroids are stored as a small table."""
    if model.fitted is not None:
        model.fitted.write().overwrite().save(f"{path}/model")
    else:
        rows = list(enumerate(model.centers))
        centers = spark.createDataFrame(rows, "cluster int, center array<double>")
        centers.coalesce(1).write.mode("overwrite").parquet(f"{path}/centers")
    kind = "model" if model.fitted is not None else "centers"
    described = spark.createDataFrame([(model.family, kind)], "family string, kind string")
    described.coalesce(1).write.mode("overwrite").json(f"{path}/kind")


def load_model(spark: SparkSession, path: str) -> ClusterModel:
    stored = spark.read.schema("family string, kind string").json(f"{path}/kind").first()
    if stored.kind == "centers":
        rows = spark.read.parquet(f"{path}/centers").orderBy("cluster").collect()
        return ClusterModel(stored.family, [list(row.center) for row in rows])
    fitted = _LOADERS[stored.family].load(f"{path}/model")
    return ClusterModel(stored.family, [c.tolist() for c in fitted.clusterCenters()], fitted)


def save_threshold(spark: SparkSession, threshold: float, path: str) -> None:
    """Write the threshold as one line of text."""
    line = spark.createDataFrame([(repr(float(threshold)),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)


def load_threshold(spark: SparkSession, path: str) -> float:
    """The first line of the threshold file as a number."""
    row = spark.read.text(path).select(F.trim("value").cast("double").alias("value")).first()
    if row is None:
        raise ValueError(f"no threshold in {path}")
    return row.value


def load_model_and_threshold(
    spark: SparkSession, model_path: str, threshold_path: str
) -> tuple[ClusterModel, float]:
    return load_model(spark, model_path), load_threshold(spark, threshold_path)
