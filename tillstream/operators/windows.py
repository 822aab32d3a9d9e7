"""Trailing windows that slide by one second, over a bounded table.

Tick ``t`` covers the rows that arrived in ``[t - span, t)``, both in whole
seconds since 1970, so ``t`` is the end of a window of ``span`` seconds.

Both jobs first reduce the lines to one row per second. They then cut the
time line into blocks and hand each block the seconds that its ticks reach
back to, so no group grows beyond one block, whatever key or period is hot,
and the many overlapping windows are only spread out after the last shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.functions.timeparts import epoch_micros, streaming_hour

INVOICE_SPAN = 40
CANCELLATION_SPAN = 480
BLOCK_SECONDS = 3600
FANOUT = 4096


def _arrival_micros(purchases: DataFrame, ts: str) -> Column:
    return epoch_micros(F.col(ts), purchases.schema[ts].dataType.typeName())


def _second(micros: Column) -> Column:
    return F.floor(micros / F.lit(1_000_000))


def _block(tick: Column) -> Column:
    return F.floor(tick / F.lit(BLOCK_SECONDS))


def _blocks_reached(second: Column, span: int) -> Column:
    """Array of the blocks that own a tick counting this second."""
    return F.sequence(_block(second + 1), _block(second + span))


def trailing_counts(
    purchases: DataFrame, span: int = CANCELLATION_SPAN, ts: str = "ts"
) -> DataFrame:
    """(tick, n) at every tick where the set of counted rows changes.

    ``n`` holds until the next row, and is 0 where the window has run empty.
    """
    seconds = (
        purchases.select(_second(_arrival_micros(purchases, ts)).alias("second"))
        .groupBy("second")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    second, rows, block = F.col("second"), F.col("rows"), F.col("block")
    start, end = block * BLOCK_SECONDS, (block + 1) * BLOCK_SECONDS
    arrives = F.struct(
        F.greatest(second + 1, start).alias("tick"),
        rows.alias("delta"),
        (second + 1 >= start).alias("is_change"),
    )
    leaves = F.struct(
        (second + 1 + span).alias("tick"),
        (-rows).alias("delta"),
        F.lit(True).alias("is_change"),
    )
    # A second that leaves in a later block is carried into that block's start.
    deltas = (
        seconds.select(
            "second", "rows", F.explode(_blocks_reached(second, span + 1)).alias("block")
        )
        .select("block", F.inline(F.array(arrives, leaves)))
        .where((F.col("tick") >= start) & (F.col("tick") < end))
        .groupBy("block", "tick")
        .agg(F.sum("delta").alias("delta"), F.max("is_change").alias("is_change"))
    )
    running = Window.partitionBy("block").orderBy("tick")
    return (
        deltas.withColumn("n", F.sum("delta").over(running))
        .where("is_change")
        .select("tick", "n")
    )


def every_second(changes: DataFrame, value: str = "n") -> DataFrame:
    """Spread change points over all ticks from the first to the last one."""
    # Each block closes with the first change of the next one, found by key.
    by_block = changes.withColumn("block", _block(F.col("tick")))
    firsts = by_block.groupBy("block").agg(F.min("tick").alias("first_tick"))
    within = Window.partitionBy("block").orderBy("tick")
    until = F.coalesce(F.lead("tick").over(within), F.col("following"), F.col("tick") + 1)
    # A gap is cut at the blocks first, and the blocks are dealt out before
    # their seconds are made, so no row holds more than a block.
    tick, last, piece = F.col("tick"), F.col("until") - 1, F.col("piece")
    pieces = (
        by_block.join(_following(firsts), "block")
        .withColumn("until", until)
        .select("tick", "until", value, F.explode(F.sequence(_block(tick), _block(last))).alias("piece"))
        .select(
            "piece",
            F.greatest(tick, piece * BLOCK_SECONDS).alias("first"),
            F.least(last, (piece + 1) * BLOCK_SECONDS - 1).alias("last"),
            value,
        )
        .repartition("piece")
    )
    return pieces.select(F.explode(F.sequence(F.col("first"), F.col("last"))).alias("tick"), value)


def _following(firsts: DataFrame, levels: int = 3) -> DataFrame:
    """The first tick of the next block for each block of ``firsts``.

    Blocks look among the next ones of their parent, the last one in the
    parent's own successor. A parent has ``FANOUT`` blocks, so no group is
    larger; above the last level all timestamps share one parent.
    """
    rows = firsts.withColumn("parent", F.floor(F.col("block") / FANOUT))
    among = Window.partitionBy("parent").orderBy("block")
    rows = rows.withColumn("following", F.lead("first_tick").over(among))
    if not levels:
        return rows.select("block", "following")
    parents = rows.groupBy(F.col("parent").alias("block")).agg(
        F.min("first_tick").alias("first_tick")
    )
    above = _following(parents, levels - 1).select(
        F.col("block").alias("parent"), F.col("following").alias("beyond")
    )
    return rows.join(above, "parent").select(
        "block", F.coalesce("following", "beyond").alias("following")
    )


def with_empty_ticks(counts: DataFrame) -> DataFrame:
    """Add the ticks between the first and the last that have no row, with n = 0."""
    empty_after = counts.select((F.col("tick") + 1).alias("tick"), F.lit(0).alias("n"))
    changes = counts.select("tick", "n").unionByName(empty_after)
    filled = every_second(changes.groupBy("tick").agg(F.max("n").alias("n")))
    last = counts.agg(F.max("tick")).scalar()
    return filled.where(F.col("tick") <= last)


def invoice_seconds(purchases: DataFrame, ts: str = "ts") -> DataFrame:
    """Well-formed lines reduced to one row per invoice and second."""
    return (
        purchases.select(
            F.col("InvoiceNo").alias("invoiceNo"),
            "Quantity",
            "UnitPrice",
            "CustomerID",
            streaming_hour(F.col("InvoiceDate")).alias("time"),
            _arrival_micros(purchases, ts).alias("arrival"),
        )
        .withColumn("second", _second(F.col("arrival")))
        .groupBy("invoiceNo", "second")
        .agg(
            F.sum("UnitPrice").alias("price_sum"),
            F.min("UnitPrice").alias("price_min"),
            F.max("UnitPrice").alias("price_max"),
            F.sum("Quantity").alias("items"),
            F.count(F.lit(1)).alias("lines"),
            F.max("arrival").alias("last_arrival"),
            F.min(F.struct("arrival", "CustomerID", "time")).alias("first_line"),
        )
    )


MEASURES = (
    "price_sum", "price_min", "price_max", "items", "lines", "last_arrival", "first_line",
)


def merge_measures() -> list[Column]:
    """Aggregates that make one measure of several over different lines."""
    return [
        F.sum("price_sum").alias("price_sum"),
        F.min("price_min").alias("price_min"),
        F.max("price_max").alias("price_max"),
        F.sum("items").alias("items"),
        F.sum("lines").alias("lines"),
        F.max("last_arrival").alias("last_arrival"),
        F.min("first_line").alias("first_line"),
    ]


def merged_seconds(partial: DataFrame) -> DataFrame:
    """One row per invoice and second from rows that each cover some of its lines."""
    return partial.groupBy("invoiceNo", "second").agg(*merge_measures())


def invoice_windows(
    purchases: DataFrame, span: int = INVOICE_SPAN, ts: str = "ts"
) -> DataFrame:
    """One row per invoice and tick whose window holds lines of the invoice."""
    return windows_of_seconds(invoice_seconds(purchases, ts), span)


def windows_of_seconds(seconds: DataFrame, span: int = INVOICE_SPAN) -> DataFrame:
    """``invoice_windows`` of lines reduced by ``invoice_seconds``."""
    return spread(window_spans(seconds, span))


def window_spans(
    seconds: DataFrame,
    span: int = INVOICE_SPAN,
    after: int | None = None,
    last: int | None = None,
) -> DataFrame:
    """Runs of ticks, ``from_tick`` up to before ``until_tick``, whose windows are alike.

    A window's content only changes when a second enters or leaves it, so the
    aggregates are computed at those change points and hold for each tick up
    to the next one. Only ticks behind ``after`` and up to ``last`` are kept.
    """
    second, block = F.col("second"), F.col("block")
    start, end = block * BLOCK_SECONDS, (block + 1) * BLOCK_SECONDS
    measures = F.struct(*MEASURES)
    nothing = F.when(F.lit(False), measures)
    points = (
        seconds.withColumn("block", F.explode(_blocks_reached(second, span)))
        .select(
            "invoiceNo",
            "block",
            F.inline(
                F.array(
                    F.struct(second.alias("point"), measures.alias("m")),
                    F.struct((second + 1).alias("point"), nothing.alias("m")),
                    F.struct((second + 1 + span).alias("point"), nothing.alias("m")),
                )
            ),
        )
        .where(F.col("point") < end)
    )
    by_point = Window.partitionBy("invoiceNo", "block").orderBy("point")
    frame = by_point.rangeBetween(-span, -1)
    first = start if after is None else F.greatest(start, F.lit(after + 1))
    until = F.coalesce(F.lead("point").over(by_point), end)
    pieces = points.select(
        "invoiceNo",
        F.greatest(F.col("point"), first).alias("from_tick"),
        (until if last is None else F.least(until, F.lit(last + 1))).alias("until_tick"),
        (F.sum("m.price_sum").over(frame) / F.sum("m.lines").over(frame)).alias("avgUnitPrice"),
        F.min("m.price_min").over(frame).alias("minUnitPrice"),
        F.max("m.price_max").over(frame).alias("maxUnitPrice"),
        F.min("m.first_line").over(frame).alias("first_line"),
        F.sum("m.items").over(frame).cast("double").alias("numberItems"),
        F.timestamp_micros(F.max("m.last_arrival").over(frame)).alias("lastUpdated"),
        F.sum("m.lines").over(frame).cast("int").alias("lines"),
    )
    return pieces.where("lines > 0 and from_tick < until_tick").select(
        "invoiceNo",
        "from_tick",
        "until_tick",
        "avgUnitPrice",
        "minUnitPrice",
        "maxUnitPrice",
        F.col("first_line.time").alias("time"),
        "numberItems",
        "lastUpdated",
        "lines",
        F.col("first_line.CustomerID").alias("customerId"),
    )


def spread(spans: DataFrame) -> DataFrame:
    """One row for each ``tick`` of ``window_spans``."""
    ticks = F.explode(F.sequence(F.col("from_tick"), F.col("until_tick") - 1)).alias("tick")
    own = [name for name in spans.columns if name not in ("invoiceNo", "from_tick", "until_tick")]
    return spans.select("invoiceNo", ticks, *own)


def first_alert_per_invoice(alerts: DataFrame, end: str = "tick") -> DataFrame:
    """The earliest window of each invoice, for consumers that want one alert."""
    columns = [name for name in alerts.columns if name not in ("invoiceNo", end)]
    return (
        alerts.groupBy("invoiceNo")
        .agg(F.min(F.struct(end, *columns)).alias("first"))
        .select("invoiceNo", "first.*")
    )
