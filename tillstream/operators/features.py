"""Per-invoice features for the cluster models."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions import rules
from tillstream.functions.timeparts import training_hour
from tillstream.schema import FEATURE_COLUMNS, WINDOW_FEATURE_COLUMNS


def with_hour(lines: DataFrame) -> DataFrame:
    """Add the training form of the hour."""
    return lines.withColumn("Hour", training_hour(F.col("InvoiceDate")))


def training_lines(lines: DataFrame) -> DataFrame:
    """Lines with a positive price and more than one item, all fields present."""
    return lines.where(rules.is_training_line())


def invoice_features(lines: DataFrame) -> DataFrame:
    """Price mean, min and max, hour of the first line and item sum per invoice.

    "First" is the earliest well-formed date, the lower hour of the two that
    a clock change lets fall together, and without such a date the lowest
    hour. So the result does not depend on row order, and a numeric ordering
    key keeps this a hash aggregate.
    """
    date = F.try_to_timestamp("InvoiceDate", F.lit("dd/MM/yyyy H:mm"))
    moment = F.unix_seconds(date) * 100 + F.col("Hour").try_cast("bigint")
    return (
        lines.withColumn("moment", moment)
        .groupBy("InvoiceNo")
        .agg(
            F.avg("UnitPrice").alias("AvgUnitPrice"),
            F.min("UnitPrice").alias("MinUnitPrice"),
            F.max("UnitPrice").alias("MaxUnitPrice"),
            F.coalesce(F.min_by("Hour", "moment"), F.min("Hour")).alias("Time"),
            F.sum("Quantity").alias("NumberItems"),
        )
    )


def training_features(lines: DataFrame) -> DataFrame:
    """Invoice features of the lines a model may learn from."""
    return invoice_features(training_lines(lines))


def assemble(rows: DataFrame, columns: list[str] = FEATURE_COLUMNS) -> DataFrame:
    """Add the five-number ``features`` vector."""
    return VectorAssembler(inputCols=columns, outputCol="features").transform(rows)


def assemble_windows(invoices: DataFrame) -> DataFrame:
    """The same vector for windowed invoices."""
    return assemble(invoices, WINDOW_FEATURE_COLUMNS)


def preview(features: DataFrame, rows: int = 30) -> DataFrame:
    """The first feature rows by invoice number."""
    return features.orderBy("InvoiceNo").limit(rows)
