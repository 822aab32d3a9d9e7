"""Live detection: malformed lines, cancellation counts and anomalous invoices."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.functions import rules
from tillstream.functions.render import invoice_value
from tillstream.functions.timeparts import training_hour
from tillstream.operators import clusters
from tillstream.operators.purchases import (
    malformed_feed,
    parse_purchases,
    well_formed,
    with_line_key,
)
from tillstream.operators.windows import first_alert_per_invoice, spread
from tillstream.plans.models import ClusterModel
from tillstream.schema import (
    CANCELLATIONS_TOPIC,
    LATE_TOPIC,
    MALFORMED_TOPIC,
    WINDOW_FEATURE_COLUMNS,
)
from tillstream.sources.sinks import TAIL
from tillstream.streaming.staging import Staging, with_heartbeat
from tillstream.streaming.windows import DEFAULT_DELAY_SECONDS

EVERY_SECOND = {"processingTime": "1 second"}
FEED_SCHEMA = "topic string, key string, value string, batch bigint"


def cancellation_feed(counts: DataFrame) -> DataFrame:
    """The count is both the key and the value of its message."""
    count = F.col("n").cast("string")
    return counts.select(
        F.lit(CANCELLATIONS_TOPIC).alias("topic"), count.alias("key"), count.alias("value")
    )


def anomalous_invoices(
    invoices: DataFrame, model: ClusterModel, threshold: float
) -> DataFrame:
    """Windowed invoices beyond the threshold of a model; batch or stream."""
    scored = model.score(invoices, WINDOW_FEATURE_COLUMNS)
    return clusters.anomalies(scored, threshold)


def anomaly_feed(alerts: DataFrame, topic: str, style: str = "record") -> DataFrame:
    return alerts.select(
        F.lit(topic).alias("topic"),
        F.col("invoiceNo").alias("key"),
        invoice_value(style).alias("value"),
    )


KEYS_SCHEMA = "key string, batch bigint, bucket int"
#: Folders that the published keys of a batch are dealt into.
KEY_BUCKETS = 64


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def write_keys(alerts: DataFrame, folder: str, batch_id: int) -> None:
    """Remember the invoices of a batch of published alerts."""
    keys = alerts.select(F.col("invoiceNo").alias("key")).withColumn("bucket", _bucket(F.col("key")))
    keys.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
        f"{folder}/batch={batch_id}"
    )


def published_before(
    spark: SparkSession, folder: str, batch_id: int, alerts: DataFrame | None = None
) -> DataFrame | None:
    """Keys published by the earlier batches; None before the first one.

    With ``alerts`` only files that may hold one of their invoices are opened.
    """
    try:
        keys = spark.read.schema(KEYS_SCHEMA).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    keys = keys.where(F.col("batch") < batch_id)
    if alerts is not None:
        buckets = alerts.select(_bucket(F.col("invoiceNo")).alias("bucket")).distinct()
        keys = keys.where(F.col("bucket").isin([row.bucket for row in buckets.collect()]))
    return keys.select("key")


def unpublished(alerts: DataFrame, published: DataFrame | None) -> DataFrame:
    """First alert of each invoice that is not among the published keys.

    Those are cut down to the invoices at hand before they meet them, so no
    number of published keys is shuffled.
    """
    first = first_alert_per_invoice(alerts, "windowEnd")
    if published is None:
        return first
    keys = first.select(F.col("invoiceNo").alias("key"))
    seen = published.select("key").join(keys, "key", "left_semi").distinct()
    return first.join(seen, F.col("invoiceNo") == F.col("key"), "left_anti")


def late_feed(lines: DataFrame) -> DataFrame:
    """The raw text of late lines, under their own topic."""
    return lines.select(
        F.lit(LATE_TOPIC).alias("topic"), F.col("key"), F.col("raw").alias("value")
    )


@dataclass
class Detection:
    """All feeds of one stream of raw lines (value, ts and maybe key).

    ``models`` maps an anomaly topic to a model and its threshold; all of them
    score the same windowed invoices. Everything the run keeps lies under
    ``checkpoint``. ``dedupe`` keeps the first alert per invoice and needs a
    file sink; ``match_training_filter`` scores only lines of the kind the
    models were trained on. ``heartbeat`` (ts, a stream) moves the windows and
    counts on while no lines come.
    """

    lines: DataFrame
    sink: object
    checkpoint: str
    models: Mapping[str, tuple[ClusterModel, float]]
    delay: int = DEFAULT_DELAY_SECONDS
    dedupe: bool = False
    match_training_filter: bool = False
    style: str = "record"
    heartbeat: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.dedupe and not hasattr(self.sink, "folder"):
            raise ValueError("dedupe looks alerts up in the written feed and needs a file sink")
        self.staging = Staging(f"{self.checkpoint}/staging", self.delay)
        self.spark = self.lines.sparkSession

    def start_staging(self, trigger: dict) -> StreamingQuery:
        """The only query that reads and parses lines; it publishes what needs no state."""
        lines = self.lines if "key" in self.lines.columns else with_line_key(self.lines)
        if self.heartbeat is not None:
            lines = with_heartbeat(lines, self.heartbeat)
        purchases = parse_purchases(lines.withColumn("raw", F.col("value")))
        scored = None
        if self.match_training_filter:
            purchases = purchases.withColumn("Hour", training_hour(F.col("InvoiceDate")))
            scored = rules.is_training_line()
        return self.staging.start(
            purchases, f"{self.checkpoint}/lines", trigger, self._publish_lines, scored
        )

    def _publish_lines(self, lines: DataFrame, batch_id: int) -> None:
        wrong = malformed_feed(lines, self.style)
        self.sink.write_batch(wrong, MALFORMED_TOPIC, batch_id)
        self.sink.write_batch(late_feed(lines.where("late")), LATE_TOPIC, batch_id)

    def start_windows(self, trigger: dict, clean: bool = False) -> list[StreamingQuery]:
        """Counts and anomalies, from the staged rows."""
        counts = cancellation_feed(self.staging.trailing_counts(self.spark, clean))
        return [
            self.sink.start(
                counts, CANCELLATIONS_TOPIC, f"{self.checkpoint}/{CANCELLATIONS_TOPIC}", trigger
            ),
            self.staging.start_invoice_windows(
                self.spark,
                f"{self.checkpoint}/anomalies",
                trigger,
                self._publish_anomalies,
                clean,
            ),
        ]

    def _publish_anomalies(self, spans: DataFrame, batch_id: int) -> None:
        """Windows that are alike are scored once and spread when they are published."""
        spark = spans.sparkSession
        spans = spans.persist()
        try:
            for topic, (model, threshold) in self.models.items():
                alerts = anomalous_invoices(spans, model, threshold)
                if self.dedupe:
                    first = alerts.withColumn("windowEnd", F.timestamp_seconds("from_tick"))
                    published = published_before(spark, self._keys(topic), batch_id, first)
                    alerts = unpublished(first, published)
                    write_keys(alerts, self._keys(topic), batch_id)
                else:
                    alerts = spread(alerts)
                self.sink.write_batch(anomaly_feed(alerts, topic, self.style), topic, batch_id)
        finally:
            spans.unpersist()

    def _keys(self, topic: str) -> str:
        return self.sink.folder(f"keys/{topic}")

    def start(self, trigger: dict | None = None, clean: bool = False) -> list[StreamingQuery]:
        """Start everything; windows come out as the watermark closes them.

        A trigger that ends by itself is waited for where others read its rows.
        """
        trigger = trigger or EVERY_SECOND
        staging = self.start_staging(trigger)
        if "availableNow" in trigger:
            staging.awaitTermination()
            self.staging.close(self.spark)
        return [staging, *self.start_windows(trigger, clean)]

    def run(self) -> None:
        """Read all there is and publish every window, those still open as well.

        Open windows are a last batch (``TAIL``). A later run withdraws it from a
        file sink, goes on where the streams stopped and publishes a new one.
        """
        topics = [CANCELLATIONS_TOPIC, *self.models]
        if hasattr(self.sink, "withdraw"):
            for topic in topics:
                self.sink.withdraw(self.spark, topic, TAIL)
        for query in self.start({"availableNow": True}):
            query.awaitTermination()
        counts = self.staging.open_counts(self.spark)
        self.sink.write_batch(cancellation_feed(counts), CANCELLATIONS_TOPIC, TAIL)
        self._publish_anomalies(self.staging.open_invoice_windows(self.spark), TAIL)

    def late_lines(self) -> int:
        """How many lines went to the late feed so far, all runs included."""
        return self.staging.facts(self.spark).late


def start_detection(
    lines: DataFrame,
    sink,
    checkpoint: str,
    models: Mapping[str, tuple[ClusterModel, float]],
    trigger: dict | None = None,
    **options,
) -> list[StreamingQuery]:
    """Start all feeds on raw lines; see ``Detection`` for the options."""
    return Detection(lines, sink, checkpoint, models, **options).start(trigger)
