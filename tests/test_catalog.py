"""Every catalog query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tillstream.plans.catalog import QUERIES
from tillstream.plans.oracles import ORACLE_SQL
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name, queries()[name], oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql(spark, name):
    rows = queries()[name](spark, SF_DIR).collect()
    assert len({row.InvoiceNo for row in rows}) == len(rows) > 0
    assert all(row.distance >= 0 and 0 <= row.prediction < row.k for row in rows)
    assert sum(row.is_anomaly for row in rows) <= 1999


def test_entry(spark):
    assert entry(spark).columns == ["CustomerID", "Country", "total_sales", "rank"]


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
