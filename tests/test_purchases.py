"""Parsing, splitting and the line rules, on hand-made lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.functions.timeparts import streaming_hour, training_hour
from tillstream.operators import features, purchases
from tillstream.schema import LINE_COLUMNS
from tillstream.sources import tables

GOOD = "536365,85123A,WHITE HOLDER,6,01/12/2010 8:26,2.55,17850,United Kingdom"


def parse(spark, *lines):
    raw = spark.createDataFrame([(line,) for line in lines], "value string")
    return purchases.parse_purchases(purchases.with_line_key(raw))


def field(line, position, new):
    parts = line.split(",")
    parts[position] = new
    return ",".join(parts)


def test_good_line(spark):
    row = parse(spark, GOOD).first()
    assert (row.key, row.InvoiceNo, row.StockCode) == ("536365", "536365", "85123A")
    assert (row.Quantity, row.UnitPrice, row.CustomerID) == (6, 2.55, "17850")
    assert row.Country == "United Kingdom"
    assert not row.is_wrong and not row.is_corrupt


def test_quoted_description(spark):
    line = '536366,85123A,"WHITE, ""X"" HOLDER",6,01/12/2010 8:26,2.55,17850,France'
    row = parse(spark, line).first()
    assert row.Description == 'WHITE, "X" HOLDER' and not row.is_wrong
    raw = spark.createDataFrame([(line,)], "value string")
    assert purchases.split_fields(raw).first().Description == '"WHITE, ""X"" HOLDER"'


@pytest.mark.parametrize(
    "line",
    [
        field(GOOD, 6, ""),
        field(GOOD, 0, ""),
        field(GOOD, 4, ""),
        field(GOOD, 7, ""),
        field(GOOD, 3, "x"),
        field(GOOD, 3, "2.5"),
        field(GOOD, 3, ""),
        field(GOOD, 3, "99999999999"),
        field(GOOD, 5, "-1"),
        field(GOOD, 5, "NaN"),
        field(GOOD, 5, "cheap"),
        "a,b,c",
        "",
        GOOD + ",extra",
    ],
)
def test_malformed_lines(spark, line):
    assert parse(spark, line).first().is_wrong


@pytest.mark.parametrize(
    "line",
    [
        field(GOOD, 3, " 5 "),
        field(GOOD, 3, '" 5 "'),
        field(GOOD, 3, "-1"),
        field(GOOD, 3, "0"),
        field(GOOD, 5, "0"),
        field(GOOD, 1, ""),
        field(GOOD, 2, ""),
    ],
)
def test_well_formed_lines(spark, line):
    assert not parse(spark, line).first().is_wrong


def test_cancellations_include_malformed_lines(spark):
    lines = [field(GOOD, 3, "-2"), field(field(GOOD, 3, "-3"), 6, ""), GOOD, field(GOOD, 3, "x")]
    found = purchases.cancelled(parse(spark, *lines))
    assert sorted(row.Quantity for row in found.collect()) == [-3, -2]


def test_malformed_feed(spark, rows):
    feed = purchases.malformed_feed(parse(spark, field(GOOD, 6, ""), "a,b,c", GOOD))
    assert rows(feed) == [
        (
            "facturas_erroneas",
            "536365",
            "Purchase(536365,6,01/12/2010 8:26,2.55,null,United Kingdom)",
        ),
        ("facturas_erroneas", "a", "Purchase(a,null,null,null,null,null)"),
    ]
    as_json = purchases.malformed_feed(parse(spark, "a,b,c"), style="json").first().value
    assert as_json == '{"InvoiceNo":"a"}'
    with pytest.raises(ValueError):
        purchases.malformed_feed(parse(spark, GOOD), style="xml")


def test_split_keeps_blanks_and_missing_fields(spark):
    raw = spark.createDataFrame([(field(GOOD, 6, ""),), ("a,b,c",)], "value string")
    blank, short = purchases.split_fields(raw).collect()
    assert blank.CustomerID == ""
    assert (short.Description, short.Quantity, short.Country) == ("c", None, None)


def test_split_agrees_with_the_lookahead_rule_on_any_text(spark):
    """Whole lines, unpaired quotes and the marks in use included."""
    pattern = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    dice = random.Random(7)
    letters = 'ab,,""\0\1'
    lines = {"".join(dice.choices(letters, k=dice.randint(0, 14))) for _ in range(4000)}
    raw = spark.createDataFrame([(line,) for line in sorted(lines)], "value string")
    split = raw.select("value", text.split_outside_quotes(F.col("value")).alias("fields"))
    for row in split.collect():
        assert row.fields == re.split(pattern, row.value), row.value


@pytest.mark.parametrize(
    ("date", "training", "streaming"),
    [
        ("01/12/2010 8:26", 8.0, 8.0),
        ("1/12/2010 08:26", 8.0, 8.0),
        ("12/1/10 8:26", 26.0, 26.0),
        ("01/12/2010 23:05", 23.0, 23.0),
        ("", -1.0, 0.0),
        ("short", -1.0, 0.0),
        ("01/12/2010", -1.0, 0.0),
        ("01/12/2010 x:26", -1.0, 0.0),
        (None, -1.0, 0.0),
    ],
)
def test_hours(spark, date, training, streaming):
    df = spark.createDataFrame([(date,)], "d string")
    row = df.select(training_hour(F.col("d")), streaming_hour(F.col("d"))).first()
    assert tuple(row) == (training, streaming)


def test_training_rule(spark):
    lines = [
        GOOD,
        field(GOOD, 6, ""),
        field(GOOD, 3, "1"),
        field(GOOD, 3, "-4"),
        field(GOOD, 5, "0"),
        field(GOOD, 5, "NaN"),
        field(GOOD, 1, ""),
        field(GOOD, 4, ""),
        field(GOOD, 7, ""),
        field(GOOD, 4, "01/12/2010 NaN:1"),
    ]
    kept = features.training_lines(features.with_hour(parse(spark, *lines)))
    assert sorted(str(row.CustomerID) for row in kept.collect()) == ["17850", "None"]


def test_argument_items(spark):
    def items(argument, separator=","):
        column = text.argument_items(F.lit(argument), separator)
        return spark.range(1).select(column).first()[0]

    assert items("France,,Spain") == ["France", "Spain"]
    assert items("") == []
    assert items("a|b|", "|") == ["a", "b"]


@pytest.mark.parametrize("quotes", [4000, 4001, 40_000, 40_001])
def test_thousands_of_quotes_split_like_few(spark, quotes):
    line = "1," + '"' * quotes + 'x,y",France'
    raw = spark.createDataFrame([(line,)], "value string")
    (row,) = raw.select(text.split_outside_quotes(F.col("value")).alias("fields")).collect()
    whole = '"' * quotes + 'x,y"'
    assert row.fields == (["1", whole, "France"] if quotes % 2 else [f"1,{whole}", "France"])


def test_lines_wider_than_the_parser(spark):
    wide = ",".join(["1"] + ["n"] * 30_000)
    commas = '1,s,"' + "," * 30_000 + ' ""q""",5,01/12/2010 8:26,2.5,17,France'
    rows = parse(spark, wide, commas).collect()
    assert [row.is_wrong for row in rows] == [True, False]
    assert rows[0].is_corrupt and rows[1].Description == "," * 30_000 + ' "q"'


def test_split_with_a_limit_gives_the_same_first_fields(spark):
    dice = random.Random(4)
    lines = ["".join(dice.choice('"",,a\x00') for _ in range(dice.randrange(40))) for _ in range(400)]
    raw = spark.createDataFrame([(line,) for line in [*lines, "1" + ",n" * 29_999]], "value string")
    whole, part = (text.split_outside_quotes(F.col("value"), limit) for limit in (-1, 9))
    for row in raw.select(whole.alias("whole"), part.alias("part")).collect():
        assert row.part[:8] == row.whole[:8]
        assert len(row.part) == min(len(row.whole), 9)


def test_hostile_lines_are_dealt_out_before_they_grow(spark, monkeypatch):
    rows = [(str(n), "P", "d", 1, "01/12/2010 8:26", 1.0, "c", "France", n % 40) for n in range(80)]
    names = [*LINE_COLUMNS, "slot"]
    monkeypatch.setattr(tables, "lines", lambda *_: spark.createDataFrame(rows, names).coalesce(1))
    built = tables.hostile_lines(spark, "")
    assert built.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1
    assert built.where(F.length("value") > 4000).count() == 10
