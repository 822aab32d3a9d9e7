"""Kafka source. It needs the spark-sql-kafka package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topics: str,
    from_beginning: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options for a comma-separated topic list.

    ``max_offsets_per_trigger`` limits what is in flight, ``min_partitions``
    splits busy topic partitions over more tasks.
    """
    names = [name.strip() for name in topics.split(",") if name.strip()]
    if not names:
        raise ValueError("no topic given")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(names),
        "startingOffsets": "earliest" if from_beginning else "latest",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(spark: SparkSession, **options) -> DataFrame:
    """(key, value, ts) lines; see ``kafka_options`` for the arguments."""
    records = spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
    )
