"""Features, clustering, elbow, threshold, saving and loading."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tillstream.operators import clusters, features
from tillstream.plans import models, training, xorshift
from tillstream.plans.models import BISECTING_KMEANS, KMEANS, ClusterModel
from tillstream.plans.passes import Blocks
from tillstream.schema import FEATURE_COLUMNS, LINE_COLUMNS

LINE_DDL = (
    "InvoiceNo string, StockCode string, Description string, Quantity int, "
    "InvoiceDate string, UnitPrice double, CustomerID string, Country string"
)


def test_features(spark, rows):
    lines = spark.createDataFrame(
        [
            ("1", "s", "d", 2, "01/12/2010 9:26", 1.0, "c", "France"),
            ("1", "t", "d", 4, "01/12/2010 8:26", 3.0, "c", "France"),
            ("1", "t", "d", 1, "01/12/2010 7:26", 99.0, "c", "France"),
            ("2", "t", "d", 5, "odd date 7:26", 2.0, "c", "France"),
            ("2", "t", "d", 5, "odd date 23:", 2.0, "c", "France"),
        ],
        LINE_DDL,
    )
    assert lines.columns == LINE_COLUMNS
    found = features.training_features(features.with_hour(lines))
    assert rows(found) == [("1", 2.0, 1.0, 3.0, 8.0, 6), ("2", 2.0, 2.0, 2.0, -1.0, 10)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    vector = features.assemble(found).orderBy("InvoiceNo").first().features
    assert list(vector) == [2.0, 1.0, 3.0, 8.0, 6.0]
    assert [row.InvoiceNo for row in features.preview(found, 1).collect()] == ["1"]


@pytest.mark.parametrize(
    ("costs", "k"),
    [
        ([100, 50, 40, 39], 3),
        ([100, 50, 25], None),
        ([100], None),
        ([100, 71], 2),
        ([5, 0, 0], None),
    ],
)
def test_elbow(spark, costs, k):
    assert clusters.elbow_from_costs(costs) == k
    table = spark.createDataFrame(
        [(i + 1, float(c)) for i, c in enumerate(costs)], "k int, cost double"
    )
    assert clusters.elbow_table(table).first().k == (k or 1)


def test_elbow_honours_the_ratio():
    assert clusters.elbow_from_costs([100, 50, 40, 39], ratio=0.9) == 4


def test_threshold_and_anomalies(spark, rows):
    scored = spark.createDataFrame([(float(d),) for d in range(1, 11)], "distance double")
    threshold = clusters.distance_threshold(scored, rank=3)
    assert threshold.first().threshold == 8.0
    assert rows(clusters.anomalies(scored, threshold)) == [(10.0,), (9.0,)]
    assert clusters.anomalies(scored, 9.5).count() == 1
    assert clusters.distance_threshold(scored, rank=2000).first().threshold == 1.0
    assert clusters.distance_threshold(scored.limit(0)).first().threshold is None


@pytest.fixture(scope="module")
def invoices(spark):
    """Three well separated groups of invoices, with a few outliers."""
    return spark.range(0, 600, 1, 4).selectExpr(
        "cast(id as string) as InvoiceNo",
        "10.0D + 100 * (id % 3) + (id % 7) as AvgUnitPrice",
        "5.0D + 50 * (id % 3) + (id % 5) as MinUnitPrice",
        "if(id % 100 = 0, 900.0D, 20.0D + 200 * (id % 3) + (id % 11)) as MaxUnitPrice",
        "cast(id % 24 as double) as Time",
        "20 + (id % 13) as NumberItems",
    )


def squared(row, center):
    return sum((row[name] - c) ** 2 for name, c in zip(FEATURE_COLUMNS, center))


@pytest.mark.parametrize("family", [KMEANS, BISECTING_KMEANS])
def test_fit_score_save_load(spark, invoices, tmp_path, family):
    vectors = features.assemble(invoices)
    model = models.fit(vectors, family, k=4, seed=3)
    scored = model.score(invoices).orderBy("InvoiceNo").collect()
    for row in scored:
        assert math.isclose(row.distance, squared(row, model.centers[row.prediction]), abs_tol=1e-6)
    cost = clusters.clustering_cost(model.score(vectors)).first().cost
    assert math.isclose(cost, sum(row.distance for row in scored), rel_tol=1e-9)
    assert cost <= model.fitted.summary.trainingCost * (1 + 1e-9)

    models.save_model(spark, model, str(tmp_path / "model"))
    models.save_model(spark, model, str(tmp_path / "model"))
    models.save_threshold(spark, 12.25, str(tmp_path / "threshold"))
    loaded, threshold = models.load_model_and_threshold(
        spark, str(tmp_path / "model"), str(tmp_path / "threshold")
    )
    assert threshold == 12.25 and loaded.family == family
    assert loaded.score(invoices).orderBy("InvoiceNo").collect() == scored


def test_plain_centroids_save_and_load(spark, invoices, tmp_path):
    model = ClusterModel(KMEANS, [[1.0, 2.0, 3.0, 4.0, 5.0], [9.0, 9.0, 9.0, 9.0, 9.0]])
    models.save_model(spark, model, str(tmp_path / "model"))
    loaded = models.load_model(spark, str(tmp_path / "model"))
    assert loaded.centers == model.centers and loaded.fitted is None
    for row in loaded.score(invoices).collect():
        distances = [squared(row, center) for center in model.centers]
        assert row.prediction == distances.index(min(distances))
        assert math.isclose(row.distance, min(distances))


def test_single_mean_matches_brute_force(invoices):
    model, cost = training.single_mean(invoices, KMEANS)
    rows = invoices.collect()
    means = [sum(row[name] for row in rows) / len(rows) for name in FEATURE_COLUMNS]
    assert all(math.isclose(a, b) for a, b in zip(model.centers[0], means))
    assert math.isclose(cost, sum(squared(row, means) for row in rows), rel_tol=1e-9)


def test_sweep_fits_every_k_and_may_stop_at_the_elbow(invoices):
    vectors = features.assemble(invoices).cache()
    full = training.sweep(vectors, KMEANS, max_k=6, ratio=0.1, parallel=3)
    assert full.elbow == 2 and full.model.k == 2 and len(full.costs) == 6
    assert len(full.models) == 6 and all(m.k <= k + 1 for k, m in enumerate(full.models))
    short = training.sweep(vectors, KMEANS, max_k=6, ratio=0.1, parallel=3, early_stop=True)
    assert short.elbow == 2 and short.costs == full.costs[:4]
    none = training.sweep(vectors, KMEANS, max_k=3, ratio=1e9)
    assert none.elbow is None and none.model.k == 1 and len(none.costs) == 3
    chosen = training.sweep(vectors, KMEANS, max_k=6)
    after = training.sweep(vectors, KMEANS, max_k=6, offset=1)
    assert after.elbow == chosen.elbow and after.model.k == min(chosen.elbow + 1, 6)
    capped = training.sweep(vectors, KMEANS, max_k=chosen.elbow, offset=1)
    assert capped.model.k == chosen.elbow
    vectors.unpersist()


def test_unknown_family_and_empty_input(spark, invoices):
    with pytest.raises(ValueError):
        training.sweep(invoices, "DBSCAN")
    with pytest.raises(ValueError):
        training.single_mean(invoices.limit(0), KMEANS)


def test_training_job(spark, tmp_path):
    lines = spark.range(0, 900, 1, 2).selectExpr(
        "cast(id % 90 as string) as InvoiceNo",
        "'s' as StockCode",
        "'with, comma' as Description",
        "cast(2 + id % 5 as int) as Quantity",
        "concat('01/12/2010 ', id % 10, ':05') as InvoiceDate",
        "if(id % 90 < 30, 1.5D, 75.0D) + id % 4 as UnitPrice",
        "cast(null as string) as CustomerID",
        "'France' as Country",
    )
    source = str(tmp_path / "lines")
    lines.write.option("header", True).csv(source)
    paths = str(tmp_path / "model"), str(tmp_path / "threshold")
    outcome = training.run(spark, source, *paths, KMEANS, max_k=4, rank=10)
    model, threshold = models.load_model_and_threshold(spark, *paths)
    assert model.k == outcome.model.k
    scored = model.score(features.training_features(features.with_hour(lines)))
    distances = sorted((row.distance for row in scored.collect()), reverse=True)
    assert math.isclose(threshold, distances[9], rel_tol=1e-9)
    assert scored.where(F.col("distance") == threshold).count() >= 1


@pytest.mark.parametrize("family", [KMEANS, BISECTING_KMEANS])
def test_one_scan_costs_every_model(spark, family):
    """The same costs as one model at a time, whatever way a family assigns rows."""
    dice = random.Random(3)
    rows = [tuple(dice.gauss(10 * (i % 4), 2.0) for _ in FEATURE_COLUMNS) for i in range(300)]
    vectors = features.assemble(spark.createDataFrame(rows, FEATURE_COLUMNS)).cache()
    fitted = [models.fit(vectors, family, k, 1) for k in (2, 3, 5)]
    together = models.costs(vectors, fitted)
    alone = [clusters.clustering_cost(model.score(vectors)).first().cost for model in fitted]
    assert together == pytest.approx(alone)
    assert models.costs(vectors, []) == []


def test_fits_keep_the_vectors_they_work_on(spark, monkeypatch):
    """Spark ML does so only for a table that is not cached itself."""
    kept = []

    class Recorder(models.KMeans):
        def fit(self, rows):
            kept.append(rows.storageLevel)
            return super().fit(rows)

    monkeypatch.setitem(models._ESTIMATORS, models.KMEANS, Recorder)
    rows = spark.createDataFrame([(float(n % 2),) * 5 for n in range(20)], FEATURE_COLUMNS)
    vectors = features.assemble(rows).persist()
    assert models.fit(vectors, models.KMEANS, 2, 1).k == 2
    vectors.unpersist()
    assert [level.useMemory or level.useDisk for level in kept] == [False]


@pytest.fixture(scope="module")
def clouds(spark):
    """Rows around nine points, some of them twice, in three partitions."""
    dice = random.Random(5)
    rows = [
        tuple(dice.gauss(10 * (i % 9), 1.0 + i % 3) for _ in FEATURE_COLUMNS) for i in range(500)
    ]
    table = spark.createDataFrame(rows + rows[:40], FEATURE_COLUMNS).repartition(3)
    vectors = features.assemble(table).cache()
    yield vectors
    vectors.unpersist()


@pytest.fixture(scope="module")
def few_values(spark):
    """Ties, and fewer different rows than clusters."""
    rows = [(float(n % 3),) * 5 for n in range(30)]
    vectors = features.assemble(spark.createDataFrame(rows, FEATURE_COLUMNS).repartition(2))
    yield vectors.cache()
    vectors.unpersist()


def joint_fits(vectors, family, ks):
    with Blocks(vectors) as blocks:
        return models.fit_all(blocks, family, ks, seed=1)


def assert_equal_fits(vectors, family, ks):
    """Joint fits give the centers, order and costs of one Spark ML fit per k."""
    joint, joint_costs = joint_fits(vectors, family, ks)
    alone = [models.fit(vectors, family, k, 1) for k in ks]
    for one, other in zip(joint, alone):
        assert one.k == other.k and one.family == family
        for a, b in zip(one.centers, other.centers):
            assert a == pytest.approx(b, rel=1e-9, abs=1e-9)
        ours, theirs = (
            [row.prediction for row in m.score(vectors).select("prediction").collect()]
            for m in (one, other)
        )
        assert ours == theirs
    assert joint_costs == pytest.approx(models.costs(vectors, alone))
    assert models.costs(vectors, joint) == pytest.approx(joint_costs)


# 5, 9 and 11 split some clusters of their last level, 14 draws in hash order
def test_joint_bisecting_equals_one_fit_per_k(clouds):
    assert_equal_fits(clouds, BISECTING_KMEANS, [2, 3, 5, 9, 11, 14])


def test_joint_kmeans_equals_one_fit_per_k(clouds):
    assert_equal_fits(clouds, KMEANS, [2, 3, 8, 13])


@pytest.mark.parametrize("family", [KMEANS, BISECTING_KMEANS])
def test_joint_fits_of_few_different_rows(few_values, family):
    assert_equal_fits(few_values, family, [2, 3, 6])


def jobs_of(spark, work):
    """The number of Spark jobs that ``work`` runs."""
    context = spark.sparkContext
    context.setJobGroup("counted", "counted")
    try:
        work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup("counted"))


# bisecting: 20 rounds and the costs for each of three levels; k-means: 20 rounds,
# two steps of two scans, the weights and the costs; up to ten jobs for the k = 1
# model, the numbers kept and the first row
@pytest.mark.parametrize(
    ("family", "most"), [(BISECTING_KMEANS, 1 + 3 * 21 + 10), (KMEANS, 26 + 10)]
)
def test_scans_do_not_grow_with_the_number_of_models(spark, clouds, family, most):
    def sweep():
        training.sweep(clouds, family, max_k=8)

    assert jobs_of(spark, sweep) <= most


def test_spark_random_numbers(spark):
    """Spark's own function starts each partition with its seed and number."""
    found = spark.range(0, 30_000, 1, 1).selectExpr("rand(77) as r").collect()
    drawn = xorshift.Doubles(77)
    ours = [*drawn.take(3), *drawn.take(20_000), *drawn.take(9_997)]
    assert ours == [row.r for row in found]
