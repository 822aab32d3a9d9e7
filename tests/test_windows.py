"""Trailing windows against brute force, across block borders and hot keys."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tillstream.operators import windows

START = datetime(2024, 1, 1, 0, 58, 0, tzinfo=timezone.utc)
DDL = (
    "InvoiceNo string, Quantity int, UnitPrice double, CustomerID string, "
    "InvoiceDate string, ts timestamp"
)


def make_lines(count, spread_seconds, invoices, seed):
    dice = random.Random(seed)
    lines = []
    for number in range(count):
        offset = dice.uniform(0, spread_seconds)
        lines.append(
            (
                dice.choice(invoices),
                dice.randint(-3, 9),
                float(dice.randint(1, 50)),
                f"c{number}",
                f"01/01/2024 {dice.randint(0, 23)}:10",
                START + timedelta(microseconds=int(offset * 1e6)),
            )
        )
    return lines


def second(ts):
    return int(ts.timestamp())


def micros(ts):
    return int(ts.timestamp()) * 1_000_000 + ts.microsecond


def brute_windows(lines, span):
    groups = {}
    for line in lines:
        for tick in range(second(line[5]) + 1, second(line[5]) + span + 1):
            groups.setdefault((line[0], tick), []).append(line)
    expected = {}
    for key, members in groups.items():
        first = min(members, key=lambda m: (m[5], m[3]))
        prices = [m[2] for m in members]
        expected[key] = (
            round(sum(prices) / len(prices), 8),
            min(prices),
            max(prices),
            float(first[4][11:].split(":")[0]),
            float(sum(m[1] for m in members)),
            micros(max(m[5] for m in members)),
            len(members),
            first[3],
        )
    return expected


@pytest.mark.parametrize(
    ("count", "spread", "invoices", "span"),
    [
        (150, 400, ["a", "b", "c"], 40),
        (60, 5000, ["a"], 40),
        (300, 90, ["hot", "hot", "cold"], 40),
        (80, 300, ["a", "b"], 1),
        (25, 9000, ["a"], 4000),
    ],
)
def test_invoice_windows(spark, count, spread, invoices, span):
    lines = make_lines(count, spread, invoices, seed=count)
    found = windows.invoice_windows(spark.createDataFrame(lines, DDL), span)
    got = {}
    for row in found.withColumn("lastUpdated", F.unix_micros("lastUpdated")).collect():
        key = (row.invoiceNo, row.tick)
        assert key not in got
        got[key] = (
            round(row.avgUnitPrice, 8),
            row.minUnitPrice,
            row.maxUnitPrice,
            row.time,
            row.numberItems,
            row.lastUpdated,
            row.lines,
            row.customerId,
        )
    assert got == brute_windows(lines, span)


@pytest.mark.parametrize(
    ("count", "spread", "span"), [(100, 1500, 480), (40, 9000, 480), (5, 3, 2)]
)
def test_trailing_counts(spark, count, spread, span):
    lines = make_lines(count, spread, ["a"], seed=count)
    seconds = [second(line[5]) for line in lines]
    changes = windows.trailing_counts(spark.createDataFrame(lines, DDL), span)
    got = {row.tick: row.n for row in changes.collect()}
    ticks = {s + 1 for s in seconds} | {s + 1 + span for s in seconds}
    assert got == {t: sum(t - span <= s < t for s in seconds) for t in ticks}
    filled = {row.tick: row.n for row in windows.every_second(changes).collect()}
    assert filled == {
        t: sum(t - span <= s < t for s in seconds) for t in range(min(ticks), max(ticks) + 1)
    }


def test_a_long_gap_is_cut_into_blocks(spark):
    """Two years between two changes never stand in one row."""
    end = 2 * 365 * 86_400
    changes = spark.createDataFrame([(5, 3), (end, 0)], "tick long, n long")
    filled = windows.every_second(changes)
    total = filled.agg(F.count("*"), F.min("tick"), F.max("tick"), F.sum("n")).first()
    assert tuple(total) == (end - 4, 5, end, 3 * (end - 5))
    assert "SinglePartition" not in filled._jdf.queryExecution().executedPlan().toString()


def test_empty_ticks(spark, rows):
    counts = spark.createDataFrame([(7200, 2), (7199, 1), (7203, 5)], "tick long, n long")
    assert rows(windows.with_empty_ticks(counts)) == [
        (7199, 1),
        (7200, 2),
        (7201, 0),
        (7202, 0),
        (7203, 5),
    ]


def test_group_size_is_bound_by_the_block(spark):
    """Ten lines a second on one invoice never meet as one group."""
    lines = spark.range(0, 100_000, 1, 8).selectExpr(
        "'hot' as InvoiceNo",
        "1 as Quantity",
        "1.0D as UnitPrice",
        "'c' as CustomerID",
        "'01/01/2024 8:10' as InvoiceDate",
        "timestamp_millis(1704067200000 + id * 100) as ts",
    )
    found = windows.invoice_windows(lines)
    summary = found.agg(F.count("*"), F.max("lines"), F.sum("lines")).first()
    assert tuple(summary) == (10_000 + 39, 400, 100_000 * 40)
    assert windows.invoice_seconds(lines).count() == 10_000


def test_first_alert(spark, rows):
    alerts = spark.createDataFrame(
        [("a", 5, 1.0), ("a", 3, 2.0), ("b", 9, 3.0)], "invoiceNo string, tick long, d double"
    )
    assert rows(windows.first_alert_per_invoice(alerts)) == [("a", 3, 2.0), ("b", 9, 3.0)]


def test_zone_less_arrival_is_utc_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        df = spark.sql("select timestamp_ntz'2024-01-01 00:00:07.5' as ts")
        assert windows.trailing_counts(df, 480).where("n > 0").first().tick == 1704067208
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
