"""One parse for all feeds: lines are staged as panes that the windows read.

Every trigger parses its lines once. What has no state is published from there;
the rest is reduced to one row per invoice and second and one row per second,
and written under the staging folder. The window queries read those rows, so
the 40 or 480 overlapping windows are spread from seconds, never from lines.

Whether a line is late is decided here and only here. A batch is held against
``cutoff``: the newest arrival of the batches before it, less the delay. A line
whose second ended by then goes to the late feed; all others go into panes. Cutoffs
are written after the panes they belong to, so nothing is dropped: each one closes
windows, and those are computed from the panes within their reach, which are the
only state, one row per invoice and second.

A batch that is run again finds its facts and leaves everything as it is, or
writes what is missing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions import rules
from tillstream.operators import windows
from tillstream.operators.windows import CANCELLATION_SPAN, INVOICE_SPAN
from tillstream.sources import files
from tillstream.streaming.windows import DEFAULT_DELAY_SECONDS, trailing_counts_of_seconds

PANES = (
    "invoiceNo string, second bigint, price_sum double, price_min double, price_max double,"
    " items bigint, lines bigint, last_arrival bigint,"
    " first_line struct<arrival: bigint, CustomerID: string, time: double>"
)
SECONDS = "second bigint, n bigint"
CLOCK = "cutoff timestamp"
FACTS = "newest bigint, lines bigint, late bigint"
#: Up to which tick windows have come out, and the first batch of panes needed and kept.
CLOSED = "closed bigint, first bigint, kept bigint"
MICROS = 1_000_000

Publish = Callable[[DataFrame, int], None]


def with_heartbeat(lines: DataFrame, beats: DataFrame) -> DataFrame:
    """``lines`` and a row for each ``ts`` of ``beats`` that only moves the clock."""
    nothing = [
        F.lit(None).cast(field.dataType).alias(field.name)
        for field in lines.schema
        if field.name != "ts"
    ]
    marked = beats.select(*nothing, F.col("ts").cast("timestamp").alias("ts"), F.lit(True).alias("beat"))
    return lines.withColumn("beat", F.lit(False)).unionByName(marked)


def every_second(spark: SparkSession) -> DataFrame:
    """A beat a second by this machine's clock."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return rate.select(F.col("timestamp").alias("ts"))


def _found(spark: SparkSession, schema: str, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _batches(spark: SparkSession, schema: str, folder: str) -> DataFrame | None:
    """All batches of a part, with their number as ``batch``."""
    try:
        return spark.read.schema(f"{schema}, batch bigint").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _time(micros: int) -> datetime:
    return datetime.fromtimestamp(micros // MICROS, timezone.utc).replace(
        microsecond=micros % MICROS
    )


@dataclass(frozen=True)
class Staging:
    """The staging folder of one detection run and the rules it is written by."""

    path: str
    delay: int = DEFAULT_DELAY_SECONDS
    span: int = CANCELLATION_SPAN

    def start(
        self,
        purchases: DataFrame,
        checkpoint: str,
        trigger: dict,
        publish: Publish | None = None,
        scored: Column | None = None,
    ) -> StreamingQuery:
        """Stage a stream of purchases.

        ``publish`` gets the lines of a batch, marked ``late``. ``scored`` says
        which of the well-formed lines count for invoices (default: all).
        """

        def stage(batch: DataFrame, batch_id: int) -> None:
            self.stage(batch, batch_id, publish, scored)

        return (
            purchases.writeStream.queryName("staging")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .foreachBatch(stage)
            .start()
        )

    def stage(
        self,
        batch: DataFrame,
        batch_id: int,
        publish: Publish | None = None,
        scored: Column | None = None,
    ) -> None:
        spark = batch.sparkSession
        if self._facts_of(spark, batch_id):
            return
        before = self._facts_of(spark, batch_id - 1) if batch_id else None
        before = before or Row(newest=None, lines=0, late=0)
        cutoff = None if before.newest is None else before.newest - self.delay * MICROS
        micros = F.unix_micros("ts")
        second = F.floor(micros / MICROS)
        is_late = F.lit(False) if cutoff is None else (second + 1) * MICROS <= cutoff
        if "beat" not in batch.columns:
            batch = batch.withColumn("beat", F.lit(False))
        batch = batch.withColumns({"second": second, "late": is_late}).persist()
        try:
            facts = batch.agg(
                F.max(micros).alias("newest"),
                F.min(second).alias("first"),
                F.count_if(~F.col("beat")).alias("lines"),
                F.count_if(~F.col("beat") & F.col("late")).alias("late"),
            ).first()
            newest = max((t for t in (before.newest, facts.newest) if t is not None), default=None)
            lines = batch.where("not beat")
            if publish:
                publish(lines, batch_id)
            if newest is not None:
                on_time = lines.where("not late")
                self._write(self._panes(on_time, scored), "invoices", batch_id, PANES)
                first = facts.first if before.newest is None else before.newest // MICROS
                seconds = self._seconds(on_time, first, newest // MICROS)
                self._write(seconds, "seconds", batch_id, SECONDS)
            if cutoff is not None:
                self._write_cutoff(spark, cutoff, f"batch={batch_id}")
            row = [(newest, before.lines + facts.lines, before.late + facts.late)]
            spark.createDataFrame(row, FACTS).coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/facts/batch={batch_id}"
            )
        finally:
            batch.unpersist()

    @staticmethod
    def _panes(lines: DataFrame, scored: Column | None) -> DataFrame:
        valid = lines.where("not is_wrong") if "is_wrong" in lines.columns else lines
        return windows.invoice_seconds(valid if scored is None else valid.where(scored))

    def _seconds(self, lines: DataFrame, first: int, newest: int) -> DataFrame:
        """Cancellations of every second that has lines, and zeros in between.

        A zero every ``span`` seconds is enough: it reaches the next one.
        """
        counted = lines.groupBy("second").agg(F.count_if(rules.is_cancellation()).alias("n"))
        zero = F.lit(0).cast("bigint").alias("n")
        steady = lines.sparkSession.range(
            -(-first // self.span) * self.span, newest, self.span
        ).select(F.col("id").alias("second"), zero)
        last = lines.sparkSession.range(newest, newest + 1).select(F.col("id").alias("second"), zero)
        rows = counted.unionByName(steady).unionByName(last)
        # one row per second of the batch, in one file that appears at once
        return rows.groupBy("second").agg(F.sum("n").alias("n")).coalesce(1)

    def _write(self, rows: DataFrame, name: str, batch_id: int, schema: str) -> None:
        """Write a part of a batch unless an attempt before has done so."""
        folder = f"{self.path}/{name}/batch={batch_id}"
        there = _found(rows.sparkSession, schema, folder)
        if there is None or there.count() != rows.count():
            rows.write.mode("overwrite").parquet(folder)

    def _write_cutoff(self, spark: SparkSession, cutoff: int, name: str) -> None:
        folder = f"{self.path}/clock/{name}"
        if _found(spark, CLOCK, folder) is None:
            rows = spark.createDataFrame([(_time(cutoff),)], CLOCK)
            rows.coalesce(1).write.parquet(folder)

    def _facts_of(self, spark: SparkSession, batch_id: int) -> Row | None:
        facts = _found(spark, FACTS, f"{self.path}/facts/batch={batch_id}")
        return facts and facts.first()

    def facts(self, spark: SparkSession) -> Row:
        """newest arrival (microseconds), lines and late lines so far."""
        facts = _found(spark, FACTS, f"{self.path}/facts")
        if facts is None:
            return Row(newest=None, lines=0, late=0)
        return facts.agg(
            F.max("newest").alias("newest"),
            F.coalesce(F.max("lines"), F.lit(0)).alias("lines"),
            F.coalesce(F.max("late"), F.lit(0)).alias("late"),
        ).first()

    def close(self, spark: SparkSession) -> None:
        """Let the windows close up to the newest line, at the end of a bounded run."""
        newest = self.facts(spark).newest
        if newest is not None:
            self._write_cutoff(spark, newest - self.delay * MICROS, f"closing={newest}")

    def start_invoice_windows(
        self,
        spark: SparkSession,
        checkpoint: str,
        trigger: dict,
        publish: Publish,
        clean: bool = False,
    ) -> StreamingQuery:
        """Publish the spans (``window_spans``) of the windows that each cutoff closes.

        ``clean`` deletes cutoffs that were read and panes no window needs any more.
        """

        def close(cutoffs: DataFrame, batch_id: int) -> None:
            self._close_windows(cutoffs, batch_id, f"{checkpoint}/closed", publish, clean)

        return (
            files.stream_table(spark, f"{self.path}/clock", CLOCK, clean=clean)
            .writeStream.queryName("windows")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .foreachBatch(close)
            .start()
        )

    def _close_windows(
        self, cutoffs: DataFrame, batch_id: int, folder: str, publish: Publish, clean: bool
    ) -> None:
        spark = cutoffs.sparkSession
        before = _found(spark, CLOSED, f"{folder}/batch={batch_id - 1}") if batch_id else None
        before = before.first() if before is not None else Row(closed=None, first=0, kept=0)
        newest = cutoffs.agg(F.max(F.unix_micros("cutoff"))).first()[0]
        ticks = [before.closed, None if newest is None else newest // MICROS]
        closed = max((tick for tick in ticks if tick is not None), default=None)
        first, kept = before.first, before.kept
        if closed is not None:
            publish(self._spans(spark, first, before.closed, closed), batch_id)
            first = self._needed(spark, first, closed)
        if clean:
            # all that this batch needs if it is run again stays
            for batch in range(kept, before.first):
                files.delete_folder(spark, f"{self.path}/invoices/batch={batch}")
            kept = before.first
        row = spark.createDataFrame([(closed, first, kept)], CLOSED)
        row.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    def _needed(self, spark: SparkSession, first: int, closed: int) -> int:
        """The first batch with panes that a window beyond ``closed`` may reach."""
        facts = _batches(spark, FACTS, f"{self.path}/facts")
        if facts is None:
            return first
        reaches = F.col("newest") >= (closed - INVOICE_SPAN) * MICROS
        found = facts.where(F.col("batch") >= first).agg(
            F.min(F.when(reaches, F.col("batch"))).alias("needed"), F.max("batch").alias("last")
        )
        needed, last = found.first()
        if needed is not None:
            return needed
        return first if last is None else last + 1

    def _spans(
        self, spark: SparkSession, first: int, after: int | None, last: int | None
    ) -> DataFrame:
        """Windows that end behind ``after`` and up to ``last``, from the panes of batch ``first`` on."""
        panes = _batches(spark, PANES, f"{self.path}/invoices")
        if panes is None:
            return windows.window_spans(spark.createDataFrame([], PANES))
        recent = panes.where(F.col("batch") >= first)
        if after is not None:
            recent = recent.where(F.col("second") >= after - INVOICE_SPAN)
        if last is not None:
            recent = recent.where(F.col("second") < last)
        merged = windows.merged_seconds(recent.select("invoiceNo", "second", *windows.MEASURES))
        return windows.window_spans(merged, INVOICE_SPAN, after, last)

    def trailing_counts(self, spark: SparkSession, clean: bool = False) -> DataFrame:
        """Stream of (tick, n), a row for every second."""
        seconds = files.stream_table(spark, f"{self.path}/seconds", SECONDS, clean=clean)
        return trailing_counts_of_seconds(seconds, self.span, self.delay)

    def open_invoice_windows(self, spark: SparkSession) -> DataFrame:
        """Spans of the windows that no cutoff has closed after a bounded run."""
        newest = self.facts(spark).newest
        if newest is None:
            return windows.window_spans(spark.createDataFrame([], PANES))
        closed = (newest - self.delay * MICROS) // MICROS
        return self._spans(spark, self._needed(spark, 0, closed), closed, None)

    def open_counts(self, spark: SparkSession) -> DataFrame:
        """The (tick, n) that no watermark has closed after a bounded run."""
        newest = self.facts(spark).newest
        seconds = _found(spark, SECONDS, f"{self.path}/seconds")
        if seconds is None:
            return spark.createDataFrame([], "tick bigint, n bigint")
        closed = newest // MICROS - self.delay
        reach = F.sequence(F.col("second") + 1, F.col("second") + self.span)
        return (
            seconds.where(F.col("second") >= closed - self.span)
            .select("n", F.explode(reach).alias("tick"))
            .where(F.col("tick") > closed)
            .groupBy("tick")
            .agg(F.sum("n").alias("n"))
        )
