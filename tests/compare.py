"""Run catalog queries next to their SQL and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

# Column types that mean the same on both sides.
SAME_TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return repr(float(value))
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, connection, sf_dir: str, name: str, query, sql: str) -> str:
    """Empty text when both sides give the same rows, else what differs."""
    frame = query(spark, sf_dir)
    spark_rows = [tuple(row) for row in frame.collect()]
    result = connection.execute(sql)
    sql_names = [column[0] for column in result.description]
    if sorted(frame.columns) != sorted(sql_names):
        return f"columns {sorted(frame.columns)} != {sorted(sql_names)}"
    sql_rows = result.fetchall()
    types = {name: SAME_TYPES[kind] for name, kind in frame.dtypes}
    sql_types = {column[0]: str(column[1]) for column in result.description}
    if types != sql_types:
        return f"types {sorted(types.items() ^ sql_types.items())}"
    left, right = _rows(frame.columns, spark_rows), _rows(sql_names, sql_rows)
    if left == right:
        return "" if left else "no rows on either side"
    return (
        f"{len(spark_rows)} vs {len(sql_rows)} rows; only Spark: "
        f"{list((left - right).items())[:3]}; only SQL: {list((right - left).items())[:3]}"
    )


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tillstream.session import build_session

    sf_dir = sys.argv[1]
    chosen = sys.argv[2:]
    spark = build_session(
        "compare",
        master="local[8]",
        shuffle_partitions=8,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failures = connect(sf_dir), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        begin = time.time()
        sql = oracle_sql().get(name)
        if sql is None:
            outcome = f"rows only: {query(spark, sf_dir).count()}"
        else:
            difference = compare(spark, connection, sf_dir, name, query, sql)
            failures += bool(difference)
            outcome = f"DIFFERS {difference}" if difference else "ok"
        print(f"{name:32s} {time.time() - begin:7.2f}s {outcome}", flush=True)
    print("failures", failures)


if __name__ == "__main__":
    main()
