"""Time the catalog's queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated names) choose the
tables, the cores and the queries.
"""

from __future__ import annotations

import json
import os
import time

from tillstream.plans.catalog import QUERIES
from tillstream.session import build_session

HEADLINE = [
    "parse_lines_typed",
    "split_csv_fields",
    "malformed_feed",
    "split_volume",
    "customer_totals",
    "customer_totals_from_text",
    "top_sales_by_country",
    "top_cancellations_by_country",
    "training_lines",
    "invoice_features",
    "invoice_windows_40s",
    "invoice_windows_dense",
    "cancellations_trailing_8min",
    "cancellations_every_second",
    "distance_fixed_centers",
    "threshold_top2000",
    "anomalies_fixed_centers",
    "single_cluster_baseline",
    "elbow_choice",
    "window_anomalies",
    "first_anomaly_per_invoice",
    "kmeans_train_score",
    "bisecting_train_score",
    "stream_customer_totals",
    "stream_top_sales",
    "stream_cancellations",
]


def run(spark, query, sf_dir: str) -> float:
    """Seconds to compute every row and column of a query."""
    begin = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - begin, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    seconds = {name: run(spark, QUERIES[name], sf_dir) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
