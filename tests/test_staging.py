"""Staged lines: bounded runs that lose nothing, late lines, steady counts, one parse."""

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tillstream.operators import purchases, windows
from tillstream.plans.models import KMEANS, ClusterModel
from tillstream.schema import (
    CANCELLATIONS_TOPIC,
    KMEANS_ANOMALIES_TOPIC,
    LATE_TOPIC,
    MALFORMED_TOPIC,
)
from tillstream.session import streaming_session
from tillstream.sources import files
from tillstream.sources.sinks import TAIL, FileSink
from tillstream.streaming.detection import Detection
from tillstream.streaming.staging import PANES, Staging, with_heartbeat
from tillstream.streaming.windows import invoice_window_stream

AT_ONCE = {"availableNow": True}
START = datetime(2024, 1, 1, 9, 0, 0, tzinfo=timezone.utc)
SECOND = int(START.timestamp())
RAW = "value string, ts timestamp"
FAR = ClusterModel(KMEANS, [[-1000.0, 0.0, 0.0, 0.0, 0.0]])


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark)


def line(number, invoice, offset, quantity=1, country="France"):
    value = f"{invoice},s,text {number},{quantity},01/01/2024 9:00,{1 + number % 7},c{number},{country}"
    return value, START + timedelta(seconds=offset)


def append(session, folder, rows, schema=RAW):
    session.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)


def parsed(lines):
    return purchases.parse_purchases(purchases.with_line_key(lines))


def detection(session, folder, tmp_path, **options):
    lines = files.stream_table(session, folder, RAW, max_files=1)
    sink = FileSink(str(tmp_path / "feeds"))
    models = {KMEANS_ANOMALIES_TOPIC: (FAR, 0.0)}
    return Detection(lines, sink, str(tmp_path / "checkpoint"), models, **options), sink


def published_counts(spark, sink):
    """How often each count was published."""
    rows = sink.read(spark, CANCELLATIONS_TOPIC).groupBy("value").count().collect()
    return {int(r.value): r["count"] for r in rows}


def expected_counts(lines, last_second):
    """The same from the lines (value, ts), tick by tick."""
    seconds = [(int(ts.timestamp()), ",-" in value) for value, ts in lines]
    cancelled = [s for s, is_cancelled in seconds if is_cancelled]
    counts = {}
    for tick in range(min(s for s, _ in seconds) + 1, last_second + 481):
        n = sum(tick - 480 <= s < tick for s in cancelled)
        counts[n] = counts.get(n, 0) + 1
    return counts


def expected_alerts(spark, lines):
    """Invoice and windows of it; every window is far from the model."""
    valid = purchases.well_formed(parsed(spark.createDataFrame(lines, RAW)))
    rows = windows.invoice_windows(valid).groupBy("invoiceNo").count().collect()
    return {r.invoiceNo: r["count"] for r in rows}


def published_alerts(spark, sink):
    rows = sink.read(spark, KMEANS_ANOMALIES_TOPIC).groupBy("key").count().collect()
    return {r.key: r["count"] for r in rows}


@pytest.fixture(scope="module")
def disorder():
    """Files of lines: most in order, some late by up to a minute, with a gap."""
    dice = random.Random(5)
    batches, number = [], 0
    for at in (0, 30, 60, 1400, 1420):
        rows = []
        for _ in range(40):
            offset = at + dice.uniform(0, 30) - (dice.choice([0, 0, 0, 5, 60]) if at else 0)
            country = "" if number % 9 == 0 else "France"
            rows.append(line(number, f"i{number % 5}", max(offset, 0), dice.choice([-1, 2]), country))
            number += 1
        batches.append(rows)
    return batches


def is_late(rows, newest, delay):
    """Lines of a batch whose second ended ``delay`` before the newest line before it."""
    if newest is None:
        return []
    limit = newest - timedelta(seconds=delay)
    return [r for r in rows if r[1].replace(microsecond=0) + timedelta(seconds=1) <= limit]


def test_windows_and_late_lines_are_all_lines(spark, session, disorder, tmp_path):
    folder, late, newest = str(tmp_path / "lines"), [], None
    for rows in disorder:
        append(session, folder, rows)
        late += is_late(rows, newest, 10)
        newest = max([newest] * bool(newest) + [ts for _, ts in rows])
    job, sink = detection(session, folder, tmp_path)
    job.run()
    every = [row for rows in disorder for row in rows]
    on_time = [row for row in every if row not in late]
    found = sink.read(spark, LATE_TOPIC).collect()
    assert sorted(r.value for r in found) == sorted(value for value, _ in late)
    assert job.late_lines() == len(late) > 5
    assert published_alerts(spark, sink) == expected_alerts(spark, on_time)
    assert published_counts(spark, sink) == expected_counts(on_time, int(newest.timestamp()))
    wrong = sink.read(spark, MALFORMED_TOPIC).count()
    assert wrong == sum(value.endswith(",") for value, _ in every)


def test_a_later_run_takes_the_open_windows_back(spark, session, disorder, tmp_path):
    """Two runs publish what one run over all lines does."""
    folder = str(tmp_path / "lines")
    for rows in disorder[:2]:
        append(session, folder, rows)
    job, sink = detection(session, folder, tmp_path, delay=100)
    job.run()
    first = [row for rows in disorder[:2] for row in rows]
    assert published_alerts(spark, sink) == expected_alerts(spark, first)
    append(session, folder, disorder[2])
    again, sink = detection(session, folder, tmp_path, delay=100)
    again.run()
    every = first + disorder[2]
    assert again.late_lines() == 0
    assert published_alerts(spark, sink) == expected_alerts(spark, every)
    newest = max(int(ts.timestamp()) for _, ts in every)
    assert published_counts(spark, sink) == expected_counts(every, newest)
    # a run without new lines changes nothing
    detection(session, folder, tmp_path, delay=100)[0].run()
    assert published_alerts(spark, sink) == expected_alerts(spark, every)
    sink.withdraw(spark, CANCELLATIONS_TOPIC, TAIL)
    assert sum(published_counts(spark, sink).values()) < sum(expected_counts(every, newest).values())


def test_every_line_is_read_and_parsed_once(spark, session, disorder, tmp_path):
    folder = str(tmp_path / "lines")
    for rows in disorder[:3]:
        append(session, folder, rows)
    job, _ = detection(session, folder, tmp_path)
    staging, *others = job.start(AT_ONCE)
    for query in others:
        query.awaitTermination()
    progress = [p for p in staging.recentProgress if p.numInputRows]
    assert [p.numInputRows for p in progress] == [40, 40, 40]
    assert all(len(p.sources) == 1 for p in progress)
    read = [source.description for query in others for p in query.recentProgress for source in p.sources]
    assert read and all("/staging/" in description for description in read)


def test_counts_stay_steady_over_a_gap(spark, session, tmp_path):
    """A second without any line within reach still has its count, zero."""
    lines = [line(1, "a", 3, -1), line(2, "a", 1003, -1), line(3, "a", 1003.5, -2)]
    folder = str(tmp_path / "lines")
    append(session, folder, lines[:1])
    append(session, folder, lines[1:])
    job, sink = detection(session, folder, tmp_path)
    job.run()
    cancelled = purchases.cancelled(parsed(spark.createDataFrame(lines, RAW)))
    steady = windows.every_second(windows.trailing_counts(cancelled))
    # the batch form ends with the zero after the last line has left
    ends = steady.agg(F.max("tick")).first()[0]
    expected = {r.n: r["count"] for r in steady.where(F.col("tick") < ends).groupBy("n").count().collect()}
    assert published_counts(spark, sink) == expected
    assert expected[0] > 500


def test_heartbeat_moves_windows_and_counts(spark, session, tmp_path):
    """Without further lines the last windows close and zeros follow."""
    folder, beats = str(tmp_path / "lines"), str(tmp_path / "beats")
    append(session, folder, [line(1, "a", 0, -1)])
    append(session, beats, [(START + timedelta(seconds=s),) for s in (1, 700)], "ts timestamp")
    beat_stream = files.stream_table(session, beats, "ts timestamp")
    job, sink = detection(session, folder, tmp_path, heartbeat=beat_stream)
    for query in job.start(AT_ONCE):
        query.awaitTermination()
    assert published_alerts(spark, sink) == {"a": 40}
    counts = published_counts(spark, sink)
    assert counts[1] == 480 and counts[0] == 700 - 10 - 480
    assert sink.read(spark, MALFORMED_TOPIC).count() == 0


def test_a_batch_that_is_run_again_is_staged_once(spark, tmp_path):
    staging = Staging(str(tmp_path / "staging"))
    rows = [line(n, "a", n / 10) for n in range(30)]
    batch = parsed(spark.createDataFrame(rows, RAW))
    seen = []
    for _ in range(2):
        staging.stage(batch, 0, lambda lines, batch_id: seen.append(lines.count()))
    assert seen == [30]
    assert tuple(staging.facts(spark)) == (SECOND * 10**6 + 2_900_000, 30, 0)
    panes = spark.read.schema(PANES).parquet(f"{staging.path}/invoices/batch=0")
    assert [r.lines for r in panes.orderBy("second").collect()] == [10, 10, 10]
    # an attempt that ended before its facts were written leaves the panes alone
    files_before = sorted(p.name for p in (tmp_path / "staging/invoices/batch=0").iterdir())
    other = Staging(str(tmp_path / "other"))
    other.stage(batch, 0)
    (tmp_path / "other" / "facts").rename(tmp_path / "other" / "lost")
    names = sorted(p.name for p in (tmp_path / "other/invoices/batch=0").iterdir())
    other.stage(batch, 0)
    assert names == sorted(p.name for p in (tmp_path / "other/invoices/batch=0").iterdir())
    assert files_before == sorted(p.name for p in (tmp_path / "staging/invoices/batch=0").iterdir())


def test_heartbeat_rows_have_no_values(spark):
    lines = spark.createDataFrame([("k", "v", START)], "key string, value string, ts timestamp")
    beats = spark.createDataFrame([(START,)], "ts timestamp")
    rows = with_heartbeat(lines, beats).orderBy("beat").collect()
    assert [(r.key, r.value, r.beat) for r in rows] == [("k", "v", False), (None, None, True)]


def test_lines_are_not_spread_over_windows(session, tmp_path):
    """The 40 windows come after the first aggregation, so panes are spread."""
    append(session, str(tmp_path / "lines"), [line(1, "a", 0)])
    stream = files.stream_table(session, str(tmp_path / "lines"), RAW)
    windowed = invoice_window_stream(purchases.well_formed(parsed(stream)))
    query = windowed.writeStream.format("memory").queryName("panes").trigger(**AT_ONCE).start()
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert plan.index("Expand") < plan.index("StateStoreSave", plan.index("Expand"))
    assert plan.count("StateStoreSave") == 2


def test_no_lines(spark, session, tmp_path):
    folder = str(tmp_path / "lines")
    append(session, folder, [], RAW)
    job, sink = detection(session, folder, tmp_path)
    job.run()
    assert sink.read(spark, CANCELLATIONS_TOPIC).count() == 0
    assert sink.read(spark, KMEANS_ANOMALIES_TOPIC).count() == 0


def test_windows_keep_panes_and_no_state(spark, session, disorder, tmp_path):
    """Windows are made when they close; nothing is kept for each of an invoice's 40."""
    folder = str(tmp_path / "lines")
    for rows in disorder[:3]:
        append(session, folder, rows)
    job, _ = detection(session, folder, tmp_path)
    _, _, invoices = job.start(AT_ONCE)
    invoices.awaitTermination()
    progress = [p for p in invoices.recentProgress if p.numInputRows]
    assert progress and not [op for p in progress for op in p.stateOperators]


def test_windows_of_several_runs_that_clean(spark, session, disorder, tmp_path):
    """Panes that no window needs any more are deleted; what is published stays whole."""
    folder, every, newest = str(tmp_path / "lines"), [], None
    for rows in disorder:
        append(session, folder, rows)
        late = is_late(rows, newest, 10)
        every += [row for row in rows if row not in late]
        newest = max([newest] * bool(newest) + [ts for _, ts in rows])
        job, sink = detection(session, folder, tmp_path)
        for query in job.start(AT_ONCE, clean=True):
            query.awaitTermination()
    kept = {p.name for p in (tmp_path / "checkpoint/staging/invoices").iterdir()}
    assert kept and not {"batch=0", "batch=1"} & kept
    job._publish_anomalies(job.staging.open_invoice_windows(session), TAIL)
    assert published_alerts(spark, sink) == expected_alerts(spark, every)


def test_spans_hold_only_the_ticks_asked_for(spark):
    rows = [("a", second, 1.0, 1.0, 1.0, 1, 1, second, (second, "c", 9.0)) for second in (0, 5, 3590)]
    seconds = spark.createDataFrame(rows, PANES)
    ticks = windows.windows_of_seconds(seconds, 40).where("tick > 20 and tick <= 3595")
    spread = windows.spread(windows.window_spans(seconds, 40, after=20, last=3595))
    assert sorted(spread.collect()) == sorted(ticks.collect()) and ticks.count() == 30
