"""Sliding windows over a purchase stream, emitted once they are closed.

Arrival time is the event time. ``delay`` says how far out of order a line
may arrive; later ones are dropped and state older than that is released.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.functions import rules
from tillstream.functions.timeparts import streaming_hour
from tillstream.operators.windows import (
    CANCELLATION_SPAN,
    INVOICE_SPAN,
    merge_measures,
)

DEFAULT_DELAY_SECONDS = 10


def _windows(panes: DataFrame, time: Column, span: int) -> DataFrame:
    """Sliding windows over panes of an invoice; a window without lines gives no row."""
    return (
        panes.groupBy(F.window(time, f"{span} seconds", "1 second").alias("window"), "invoiceNo")
        .agg(*merge_measures())
        # an aggregate's value: the filter stays above the state
        .where("lines > 0")
        .select(
            "invoiceNo",
            F.col("window.end").alias("windowEnd"),
            (F.col("price_sum") / F.col("lines")).alias("avgUnitPrice"),
            F.col("price_min").alias("minUnitPrice"),
            F.col("price_max").alias("maxUnitPrice"),
            F.col("first_line.time").alias("time"),
            F.col("items").cast("double").alias("numberItems"),
            F.timestamp_micros("last_arrival").alias("lastUpdated"),
            F.col("lines").cast("int").alias("lines"),
            F.col("first_line.CustomerID").alias("customerId"),
        )
    )


def invoice_window_stream(
    purchases: DataFrame,
    span: int = INVOICE_SPAN,
    delay: int = DEFAULT_DELAY_SECONDS,
) -> DataFrame:
    """One row per invoice and window that slides by a second.

    Two aggregations in a chain: lines become panes of a second, and closed
    panes, not lines, are spread over the windows they lie in.
    """
    arrival = F.unix_micros("ts")
    panes = (
        purchases.withColumn("time", streaming_hour(F.col("InvoiceDate")))
        .withWatermark("ts", f"{delay} seconds")
        .groupBy(F.window("ts", "1 second").alias("pane"), F.col("InvoiceNo").alias("invoiceNo"))
        .agg(
            F.sum("UnitPrice").alias("price_sum"),
            F.min("UnitPrice").alias("price_min"),
            F.max("UnitPrice").alias("price_max"),
            F.sum("Quantity").alias("items"),
            F.count(F.lit(1)).alias("lines"),
            F.max(arrival).alias("last_arrival"),
            F.min(F.struct(arrival.alias("arrival"), "CustomerID", "time")).alias("first_line"),
        )
    )
    return _windows(panes, F.col("pane"), span)


def trailing_count_stream(
    purchases: DataFrame,
    span: int = CANCELLATION_SPAN,
    delay: int = DEFAULT_DELAY_SECONDS,
) -> DataFrame:
    """(tick, n) of cancellations for every second with lines in the trailing window.

    Every line moves the watermark, cancelled or not, so the counts go on and
    fall back to 0 when cancellations stop.
    """
    lines = purchases.select(
        F.unix_seconds("ts").alias("second"), rules.is_cancellation().cast("bigint").alias("n")
    )
    return trailing_counts_of_seconds(lines, span, delay)


def trailing_counts_of_seconds(
    seconds: DataFrame, span: int = CANCELLATION_SPAN, delay: int = DEFAULT_DELAY_SECONDS
) -> DataFrame:
    """(tick, n) from rows of (second, n), a tick for each second that some row reaches.

    Each row reaches the ``span`` ticks that follow it. This stays in generated
    code, which a window of hundreds of overlaps does not, and the ticks of a
    batch are summed before the shuffle. The watermark is on the tick, so it
    runs ``span`` seconds ahead of the rows.
    """
    ticks = F.sequence(F.col("second") + 1, F.col("second") + span)
    return (
        seconds.select("n", F.explode(ticks).alias("tick"))
        .withColumn("tick", F.timestamp_seconds("tick"))
        .withWatermark("tick", f"{span + delay} seconds")
        .groupBy("tick")
        .agg(F.sum("n").alias("n"))
    )
