"""Amounts, totals and top-N answers."""

import pytest

from tillstream.operators import purchases, totals
from tillstream.schema import LINE_COLUMNS

DDL = "Quantity string, UnitPrice string, CustomerID string, Country string"


def line(spark, quantity, price, customer="c", country="France"):
    return spark.createDataFrame([(quantity, price, customer, country)], DDL)


@pytest.mark.parametrize(
    ("quantity", "price", "sales", "cancellations"),
    [
        ("6", "2.5", 15.0, 0.0),
        ("-1", "27.5", 0.0, 27.5),
        ("+2", "1.5", 3.0, 0.0),
        ("0", "3.75", 0.0, 0.0),
        ("-3", "0", 0.0, 0.0),
        ("-2", "-4", 8.0, 0.0),
    ],
)
def test_volume(spark, quantity, price, sales, cancellations):
    row = totals.split_volume(totals.with_amount(line(spark, quantity, price))).first()
    assert (row.sales, row.cancellations) == (sales, cancellations)
    assert str(row.cancellations) != "-0.0" and str(row.sales) != "-0.0"


@pytest.mark.parametrize(
    ("quantity", "price"),
    [("x", "1"), ("2.5", "1"), (" 5 ", "1"), ("", "1"), ("5", "x"), ("5", "NaN"), ("5", "")],
)
def test_unparsable_amounts_are_dropped(spark, quantity, price):
    assert totals.with_amount(line(spark, quantity, price)).count() == 0


def test_blank_owner_is_a_group_and_missing_owner_is_not(spark, rows):
    rows_in = [("1", "2", "", "France"), ("1", "3", None, "France"), ("2", "5", "c", "France")]
    lines = spark.createDataFrame(rows_in, DDL)
    assert rows(totals.customer_totals(lines)) == [
        ("", "France", 2.0, 0.0),
        ("c", "France", 10.0, 0.0),
    ]
    assert rows(totals.customer_totals(lines, drop_blank=True)) == [("c", "France", 10.0, 0.0)]


TOTALS = [
    ("a", "France", 5.0, 1.0),
    ("b", "France", 9.0, 0.0),
    ("c", "France", 5.0, 3.0),
    ("d", "Spain", 0.0, 2.0),
    ("e", "Italy", 99.0, 9.0),
]


@pytest.fixture
def some_totals(spark):
    return spark.createDataFrame(
        TOTALS, "CustomerID string, Country string, sales double, cancellations double"
    )


def test_top_sales(some_totals, rows):
    top = totals.top_sales(some_totals, "France,,Spain", n=2)
    assert rows(top) == [
        ("a", "France", 5.0, 2),
        ("b", "France", 9.0, 1),
        ("d", "Spain", 0.0, 1),
    ]


def test_top_cancellations(some_totals, rows):
    top = totals.top_cancellations(some_totals, "France", n=5)
    assert rows(top) == [("a", "France", 1.0, 2), ("b", "France", 0.0, 3), ("c", "France", 3.0, 1)]


def test_repeated_country_repeats_its_rows(some_totals, rows):
    top = totals.top_sales(some_totals, "France,France", n=3)
    assert rows(top) == [("a", "France", 5.0, 3), ("b", "France", 9.0, 1), ("b", "France", 9.0, 2)]


def test_no_country_and_long_list(some_totals, rows):
    assert rows(totals.top_sales(some_totals, ",")) == []
    short = rows(totals.top_sales(some_totals, "Spain,Italy,Spain"))
    unknown = ",".join(f"N{i}" for i in range(12_000))
    assert rows(totals.top_sales(some_totals, f"Spain,Italy,Spain,{unknown}")) == short


def test_country_list_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "lines")
    lines = spark.createDataFrame(
        [(1, 2.0, "c", "France"), (1, 2.0, "d", "Spain")],
        "Quantity int, UnitPrice double, CustomerID string, Country string",
    )
    lines.write.parquet(path)
    top = totals.top_sales(totals.customer_totals(spark.read.parquet(path)), "France")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(Country,France)" in plan
    assert "WindowGroupLimit" in plan
    assert [row.CustomerID for row in top.collect()] == ["c"]


def test_totals_from_raw_text(spark, rows):
    values = [
        "1,s,\"a, b\",2,d,1.5,c,France",
        "1,s,x,-1,d,4,c,France",
        "short,row",
        "2,s,x,1,d,1,,France",
    ]
    raw = spark.createDataFrame([(value,) for value in values], "value string")
    fields = purchases.split_fields(raw)
    assert fields.columns == LINE_COLUMNS
    assert rows(totals.customer_totals(fields)) == [
        ("", "France", 1.0, 0.0),
        ("c", "France", 3.0, 4.0),
    ]


def test_hot_customer(spark, rows):
    """A third of all lines on one customer, spread over many tasks."""
    lines = spark.range(0, 30_000, 1, 16).selectExpr(
        "1 as Quantity",
        "1.0D as UnitPrice",
        "if(id % 3 = 0, 'hot', cast(id as string)) as CustomerID",
        "'France' as Country",
    )
    top = totals.top_sales(totals.customer_totals(lines), "France", n=1)
    assert rows(top) == [("hot", "France", 10_000.0, 1)]
