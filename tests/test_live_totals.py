"""Live totals: asked of the state at any time, and kept as buckets with changes."""

import time

import pytest

from tillstream.operators.totals import customer_totals
from tillstream.session import streaming_session
from tillstream.sources import files
from tillstream.streaming import totals

LINES = "Quantity int, UnitPrice double, CustomerID string, Country string"
CHANGED = "CustomerID string, Country string, sales double, cancellations double"


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark)


def test_state_is_asked_while_the_query_runs(spark, session, tmp_path, rows):
    folder, checkpoint = str(tmp_path / "lines"), str(tmp_path / "c")
    batches = [
        [(2, 5.0, "a", "France"), (-1, 7.0, "b", "France"), (1, 1.0, "x", "Spain")],
        [(1, 100.0, "c", "France"), (-3, 1.0, "a", "France"), (0, 1.0, "d", "Italy")],
    ]
    session.createDataFrame(batches[0], LINES).coalesce(1).write.parquet(folder)
    query = totals.start_totals(
        files.stream_table(session, folder, LINES),
        totals.TotalsStore(str(tmp_path / "log")),
        checkpoint,
        {"processingTime": "200 milliseconds"},
    )
    try:
        query.processAllAvailable()
        sales, cancelled = totals.top_customers(spark, checkpoint, "France")
        assert [tuple(r) for r in sales.orderBy("rank").collect()] == [
            ("a", "France", 10.0, 1), ("b", "France", 0.0, 2)
        ]
        session.createDataFrame(batches[1], LINES).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
        query.processAllAvailable()
        assert query.isActive
        every = spark.createDataFrame(batches[0] + batches[1], LINES)
        assert rows(totals.totals_from_state(spark, checkpoint)) == rows(customer_totals(every))
        sales, cancelled = totals.top_customers(spark, checkpoint, "France,Spain", n=1)
        assert {tuple(r)[:3] for r in sales.collect()} == {
            ("c", "France", 100.0), ("x", "Spain", 1.0)
        }
        assert {tuple(r)[:3] for r in cancelled.collect()} == {
            ("b", "France", 7.0), ("x", "Spain", 0.0)
        }
    finally:
        query.stop()


def test_a_reader_opens_a_bounded_number_of_folders(spark, tmp_path, rows):
    """Hundreds of triggers, batches that are run again, and a stop amid a merge."""
    store = totals.TotalsStore(str(tmp_path / "store"), keep=4, buckets=2)
    expected = {}
    for batch_id in range(30):
        key = (f"c{batch_id % 7}", "France")
        old = expected.get(key, (0.0, 0.0))
        expected[key] = (old[0] + 1.0 + batch_id, old[1] + 0.5)
        changed = spark.createDataFrame([(*key, *expected[key])], CHANGED).coalesce(1)
        store.write_batch(changed, batch_id)
        if batch_id % 9 == 0 or batch_id in (7, 11):
            store.write_batch(changed, batch_id)
        if batch_id in (2, 3, 8, 15, 29):
            assert rows(store.read(spark)) == sorted((*k, *v) for k, v in expected.items())
    merged, folders = store.folders(spark)
    assert merged == 27 and len(folders) == 1 + 8
    written = list((tmp_path / "store").rglob("*.parquet"))
    # eight changes, two sets of at most two files, two manifests
    assert len(written) <= 8 * 2 + 2 * 2 + 2
    assert len(store._rows(spark).inputFiles()) <= 8 + 2


def test_an_unfinished_merge_changes_nothing(spark, tmp_path, rows):
    store = totals.TotalsStore(str(tmp_path / "store"), keep=2, buckets=1)
    for batch_id in range(4):
        changed = spark.createDataFrame([("c", "France", 1.0 + batch_id, 0.0)], CHANGED)
        store.write_batch(changed, batch_id)
    # a merge that got as far as its files but not to its manifest
    broken = spark.createDataFrame([("c", "France", 0.25, 0.0, 5)], totals.TOTALS)
    broken.write.mode("overwrite").parquet(store._bucket_set(5))
    assert rows(store.read(spark)) == [("c", "France", 4.0, 0.0)]
    for batch_id in (4, 5):
        changed = spark.createDataFrame([("c", "France", 1.0 + batch_id, 0.0)], CHANGED)
        store.write_batch(changed, batch_id)
    assert store.merged(spark) == 5
    assert rows(store.read(spark)) == [("c", "France", 6.0, 0.0)]


def test_no_totals_yet(spark, tmp_path):
    assert totals.TotalsStore(str(tmp_path / "none")).read(spark).collect() == []
