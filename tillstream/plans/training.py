"""Training job: invoice lines to a cluster model and its anomaly threshold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillstream.operators import clusters, features
from tillstream.plans import models
from tillstream.plans.models import ClusterModel
from tillstream.plans.passes import Blocks
from tillstream.schema import FEATURE_COLUMNS
from tillstream.session import materialize

MAX_K = 20
# Models that are fitted together when a sweep may end early.
PARALLEL_FITS = 2


@dataclass
class Sweep:
    """Outcome of a sweep: the chosen model and the costs that led to it."""

    model: ClusterModel
    elbow: int | None
    costs: list[float]
    models: list[ClusterModel]


def single_mean(rows: DataFrame, family: str) -> tuple[ClusterModel, float]:
    """The k = 1 model and its cost."""
    row = clusters.single_cluster(rows).first()
    if row.cost is None:
        raise ValueError("no invoices to train on")
    return ClusterModel(family, [[row[name] for name in FEATURE_COLUMNS]]), row.cost


def sweep(
    vectors: DataFrame,
    family: str,
    max_k: int = MAX_K,
    ratio: float = clusters.ELBOW_RATIO,
    offset: int = 0,
    seed: int = 1,
    parallel: int = PARALLEL_FITS,
    early_stop: bool = False,
) -> Sweep:
    """Fit k = 1, 2, ... ``max_k`` and choose the model at the elbow.

    The models of all k are fitted in the same scans, and one scan costs them.
    ``early_stop`` fits ``parallel`` of them at a time, and ends the sweep at
    the first k that qualifies: the choice is the same, the curve is shorter.
    ``offset=1`` picks the model after the elbow. Without an elbow the answer
    is k = 1.
    """
    models.check_family(family)
    first, cost = single_mean(vectors, family)
    fitted, costs = [first], [cost]

    elbow = None
    with Blocks(vectors) as blocks:
        while len(costs) < max_k and not (
            early_stop and elbow is not None and len(costs) >= elbow + offset
        ):
            most = len(costs) + parallel if early_stop else max_k
            ks = range(len(costs) + 1, min(most, max_k) + 1)
            wave, wave_costs = models.fit_all(blocks, family, ks, seed)
            fitted += wave
            costs += wave_costs
            elbow = clusters.elbow_from_costs(costs, ratio)
    chosen = 1 if elbow is None else min(elbow + offset, max_k)
    return Sweep(fitted[chosen - 1], elbow, costs, fitted)


def training_table(lines: DataFrame) -> DataFrame:
    """Invoice features with their vector, written to the shared folder."""
    return materialize(features.assemble(features.training_features(features.with_hour(lines))))


def train(
    lines: DataFrame,
    family: str,
    rank: int = clusters.THRESHOLD_RANK,
    **options,
) -> tuple[Sweep, float, DataFrame]:
    """Train on invoice lines; returns the sweep, the threshold and the scored invoices.

    The fits keep the numbers they read; all else reads the written table.
    """
    table = training_table(lines)
    outcome = sweep(table, family, **options)
    scored = outcome.model.score(table)
    threshold = clusters.distance_threshold(scored, rank).first().threshold
    return outcome, threshold, outcome.model.score(table)


def run(
    spark: SparkSession,
    source: str,
    model_path: str,
    threshold_path: str,
    family: str,
    **options,
) -> Sweep:
    """Read a headered CSV, train, and save the model and the threshold."""
    from tillstream.sources.files import read_invoice_csv

    models.check_family(family)
    lines = read_invoice_csv(spark, source)
    outcome, threshold, _ = train(lines, family, **options)
    models.save_model(spark, outcome.model, model_path)
    models.save_threshold(spark, threshold, threshold_path)
    return outcome
