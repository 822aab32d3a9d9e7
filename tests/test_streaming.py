"""Live jobs on small file streams, compared with batch results."""

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tillstream.operators import purchases, windows
from tillstream.operators.totals import customer_totals
from tillstream.plans.models import KMEANS, ClusterModel
from tillstream.schema import (
    CANCELLATIONS_TOPIC,
    KMEANS_ANOMALIES_TOPIC,
    MALFORMED_TOPIC,
)
from tillstream.session import streaming_session
from tillstream.sources import files
from tillstream.sources.sinks import FileSink
from tillstream.streaming import detection, totals
from tillstream.streaming.windows import invoice_window_stream, trailing_count_stream

AT_ONCE = {"availableNow": True}
START = datetime(2024, 1, 1, 9, 0, 0, tzinfo=timezone.utc)
RAW = "value string, ts timestamp"
TOTAL_SCHEMA = "CustomerID string, Country string, sales double, cancellations double"


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark)


def raw_line(invoice, offset, quantity=1, price=2.0, customer="c1", country="France"):
    value = f"{invoice},s,text,{quantity},01/01/2024 9:00,{price},{customer},{country}"
    return value, START + timedelta(seconds=offset)


def append(session, folder, lines, schema=RAW):
    """One more file, clearly younger than the one before."""
    session.createDataFrame(lines, schema).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)


def stream(session, folder, schema=RAW):
    return files.stream_table(session, folder, schema, max_files=1)


LINES = [
    [raw_line("a", 0.2, 1, 10.0, "x"), raw_line("a", 0.7, 3, 20.0, "y")],
    [raw_line("a", 30.5, -1, 60.0), raw_line("b", 31.0, 2, 5.0, country="")],
    [raw_line("b", 90.0, 2, 5.0), raw_line("a", 100.0, -4, 1.0)],
    [raw_line("z", 200.0, 1, 1.0)],
]


@pytest.fixture(scope="module")
def incoming(session, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("incoming") / "lines")
    for lines in LINES:
        append(session, folder, lines)
    return folder


def parsed(lines):
    return purchases.parse_purchases(purchases.with_line_key(lines))


def last_tick(delay=10):
    return int((START + timedelta(seconds=200 - delay)).timestamp())


def test_invoice_windows_equal_batch_when_closed(spark, session, incoming, tmp_path):
    sink = FileSink(str(tmp_path))
    valid = purchases.well_formed(parsed(stream(session, incoming)))
    sink.start(
        invoice_window_stream(valid), "w", str(tmp_path / "c"), AT_ONCE
    ).awaitTermination()
    live = sink.read(spark, "w").withColumn("tick", F.unix_seconds("windowEnd"))
    batch = windows.invoice_windows(purchases.well_formed(parsed(spark.read.parquet(incoming))))
    closed = batch.where(F.col("tick") <= last_tick())
    live = live.select(closed.columns)
    assert live.count() == closed.count() > 100
    assert live.exceptAll(closed).count() == 0


def test_window_fields(spark, session, incoming, tmp_path):
    """Line count and update time are told apart; an emptied window gives no row."""
    sink = FileSink(str(tmp_path))
    valid = purchases.well_formed(parsed(stream(session, incoming)))
    sink.start(
        invoice_window_stream(valid), "w", str(tmp_path / "c"), AT_ONCE
    ).awaitTermination()
    rows = sink.read(spark, "w").where("invoiceNo = 'a'").orderBy("windowEnd").collect()
    first = rows[0]
    assert (first.lines, first.customerId, first.numberItems) == (2, "x", 4.0)
    assert first.avgUnitPrice == 15.0 and first.time == 9.0
    assert first.lastUpdated.replace(tzinfo=timezone.utc) == START + timedelta(seconds=0.7)
    ends = [int((r.windowEnd.replace(tzinfo=timezone.utc) - START).total_seconds()) for r in rows]
    assert ends == list(range(1, 71)) + list(range(101, 141))


def test_trailing_counts_equal_batch_when_closed(spark, session, incoming, tmp_path):
    sink = FileSink(str(tmp_path))
    live = trailing_count_stream(parsed(stream(session, incoming)), span=60)
    sink.start(live, "n", str(tmp_path / "c"), AT_ONCE).awaitTermination()
    found = sink.read(spark, "n").withColumn("tick", F.unix_seconds("tick"))
    got = {r.tick: r.n for r in found.collect()}
    batch = purchases.cancelled(parsed(spark.read.parquet(incoming)))
    counts = windows.every_second(windows.trailing_counts(batch, 60)).collect()
    newest = max(got)
    assert {t: n for t, n in got.items() if n} == {
        r.tick: r.n for r in counts if r.n and r.tick <= newest
    }
    assert len(got) > 50 and 0 in got.values()


def test_totals_store_and_restart(spark, session, tmp_path, rows):
    """Totals survive a restart and equal the batch totals of all lines."""
    folder = str(tmp_path / "lines")
    store = totals.TotalsStore(str(tmp_path / "log"))
    for lines in LINES[:2], LINES[2:]:
        for some in lines:
            append(session, folder, some)
        totals.start_totals(
            stream(session, folder), store, str(tmp_path / "c"), AT_ONCE
        ).awaitTermination()
    expected = rows(customer_totals(purchases.split_fields(spark.read.parquet(folder))))
    assert rows(store.read(spark)) == expected
    assert len(list((tmp_path / "log" / "changes").glob("slot=*"))) >= 4
    compacted = store.compact(spark, str(tmp_path / "compact"))
    assert rows(compacted.read(spark)) == expected


def test_top_customers_at_every_trigger(session, incoming, tmp_path):
    answers = []

    def publish(sales, cancellations, batch_id):
        sold = sales.orderBy("rank").select("CustomerID", "total_sales")
        cancelled = cancellations.orderBy("rank").select("CustomerID", "total_cancellations")
        answers.append(([tuple(r) for r in sold.collect()], [tuple(r) for r in cancelled.collect()]))

    totals.start_top_customers(
        stream(session, incoming), "France", str(tmp_path / "c"), publish, n=2, trigger=AT_ONCE
    ).awaitTermination()
    assert answers[0] == ([("y", 60.0), ("x", 10.0)], [("x", 0.0), ("y", 0.0)])
    assert answers[-1] == ([("y", 60.0), ("c1", 11.0)], [("c1", 64.0), ("x", 0.0)])


MODEL = ClusterModel(KMEANS, [[10.0, 10.0, 10.0, 9.0, 1.0]])


def run_detection(session, folder, tmp_path, **options):
    sink = FileSink(str(tmp_path / "feeds"))
    queries = detection.start_detection(
        stream(session, folder),
        sink,
        str(tmp_path / "checkpoint"),
        {KMEANS_ANOMALIES_TOPIC: (MODEL, 100.0)},
        AT_ONCE,
        **options,
    )
    for query in queries:
        query.awaitTermination()
    return sink


def test_detection_feeds(spark, session, incoming, tmp_path):
    sink = run_detection(session, incoming, tmp_path)
    wrong = sink.read(spark, MALFORMED_TOPIC).collect()
    assert [(r.topic, r.key) for r in wrong] == [(MALFORMED_TOPIC, "b")]
    counts = sink.read(spark, CANCELLATIONS_TOPIC).select("key", "value").distinct().collect()
    assert sorted(tuple(r) for r in counts) == [("0", "0"), ("1", "1"), ("2", "2")]
    alerts = sink.read(spark, KMEANS_ANOMALIES_TOPIC)
    keys = {r.key: r["count"] for r in alerts.groupBy("key").count().collect()}
    assert keys["a"] > 1 and set(keys) <= {"a", "b"}
    values = [r.value for r in alerts.collect()]
    assert any(value.startswith("Invoice(a,15.0,10.0,20.0,9.0,4.0,17") for value in values)


def test_one_alert_per_invoice(spark, session, incoming, tmp_path):
    every = run_detection(session, incoming, tmp_path / "every")
    once = run_detection(session, incoming, tmp_path / "once", dedupe=True)
    alerts = once.read(spark, KMEANS_ANOMALIES_TOPIC).collect()
    repeated = every.read(spark, KMEANS_ANOMALIES_TOPIC)
    assert sorted(r.key for r in alerts) == sorted(
        r.key for r in repeated.select("key").distinct().collect()
    )
    assert len(alerts) < repeated.count()


def test_published_alerts_are_left_out(spark, tmp_path):
    alerts = spark.createDataFrame(
        [("a", 2, 1.0), ("a", 1, 2.0), ("b", 3, 3.0)], "invoiceNo string, windowEnd long, d double"
    )
    folder = str(tmp_path / "keys")
    assert detection.published_before(spark, folder, 1) is None
    assert detection.unpublished(alerts, None).count() == 2
    detection.write_keys(alerts.where("invoiceNo = 'a'"), folder, 0)
    earlier = detection.published_before(spark, folder, 1, alerts)
    assert [tuple(r) for r in detection.unpublished(alerts, earlier).collect()] == [("b", 3, 3.0)]
    rerun = detection.published_before(spark, folder, 0, alerts)
    assert detection.unpublished(alerts, rerun).count() == 2


def test_only_files_that_may_hold_a_key_are_opened(spark, tmp_path):
    folder = str(tmp_path / "keys")
    for batch_id in range(3):
        rows = [(f"i{batch_id}-{n}",) for n in range(300)]
        detection.write_keys(spark.createDataFrame(rows, "invoiceNo string"), folder, batch_id)
    alerts = spark.createDataFrame([("i1-7",), ("new",)], "invoiceNo string")
    every = detection.published_before(spark, folder, 3)
    some = detection.published_before(spark, folder, 3, alerts)
    assert every.count() == 900
    opened = {row[0] for row in some.select(F.input_file_name()).distinct().collect()}
    assert 0 < len(opened) <= 2 * 3 < 150 < len(every.inputFiles())
    assert some.where("key = 'i1-7'").count() == 1


def test_training_filter_option(spark, session, incoming, tmp_path):
    sink = run_detection(session, incoming, tmp_path, match_training_filter=True)
    values = [r.value for r in sink.read(spark, KMEANS_ANOMALIES_TOPIC).collect()]
    assert all(value.split(",")[7] == "1" for value in values)


def test_dedupe_needs_a_file_sink(session, incoming, tmp_path):
    with pytest.raises(ValueError):
        detection.start_detection(
            stream(session, incoming), object(), str(tmp_path), {}, AT_ONCE, dedupe=True
        )
