"""Running customer totals and the top customers asked of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.operators.purchases import split_fields
from tillstream.operators.totals import (
    customer_totals,
    top_cancellations,
    top_sales,
    totals_for_countries,
)

EVERY_SECOND = {"processingTime": "1 second"}


TOTALS = "CustomerID string, Country string, sales double, cancellations double, batch bigint"


def totals_from_state(
    spark: SparkSession, checkpoint: str, batch_id: int | None = None
) -> DataFrame:
    """The totals as a running query last committed them, from its state store.

    It can be asked at any time and by any session that reaches the checkpoint;
    the query goes on meanwhile. Every state partition is one task.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    # by place: the state names both aggregates alike
    value = F.col("value").cast("struct<sales: double, cancellations: double>")
    return reader.load(checkpoint).select("key.*", value.alias("value")).select(
        "CustomerID", "Country", "value.*"
    )


def top_customers(
    spark: SparkSession, checkpoint: str, countries: str, n: int = 5
) -> tuple[DataFrame, DataFrame]:
    """Top sales and top cancellations of the listed countries right now.

    State of other countries is dropped where it is read.
    """
    now = totals_from_state(spark, checkpoint)
    return top_sales(now, countries, n), top_cancellations(now, countries, n)


def latest_totals(versions: DataFrame) -> DataFrame:
    """One row per customer from several of different age; totals never shrink."""
    return versions.groupBy("CustomerID", "Country").agg(
        F.max("sales").alias("sales"), F.max("cancellations").alias("cancellations")
    )


@dataclass(frozen=True)
class TotalsStore:
    """A readable copy of the totals: hash buckets, and the changes since.

    Every trigger writes the customers that changed. The folders of ``keep``
    triggers form a ring. Each time one is full, its changes are merged into a
    new set of bucket files, two sets of which take turns, and the manifest names
    the set that holds. So a reader opens one set and at most ``2 * keep`` changes,
    however long the query has run. Totals never shrink, so merging is a maximum,
    and a batch that is run again replaces its own folder.

    A reader that takes longer than ``keep`` triggers may find its files replaced
    and has to ask again.
    """

    path: str
    keep: int = 20
    buckets: int = 16

    def write_batch(self, changed: DataFrame, batch_id: int) -> None:
        rows = changed.withColumn("batch", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").parquet(self._change(batch_id))
        if (batch_id + 1) % self.keep == 0:
            self._merge(changed.sparkSession, batch_id)

    def _change(self, batch_id: int) -> str:
        return f"{self.path}/changes/slot={batch_id % (2 * self.keep)}"

    def _bucket_set(self, batch_id: int) -> str:
        return f"{self.path}/buckets/set={(batch_id + 1) // self.keep % 2}"

    def _merge(self, spark: SparkSession, batch_id: int) -> None:
        """Write the totals up to ``batch_id`` as the other set, then point at it."""
        merged = latest_totals(self._rows(spark, batch_id))
        rows = merged.withColumn("batch", F.lit(batch_id).cast("bigint"))
        rows.repartition(self.buckets, "CustomerID", "Country").write.mode("overwrite").parquet(
            self._bucket_set(batch_id)
        )
        # two manifests take turns as well: one of them is always whole
        spark.createDataFrame([(batch_id,)], "merged bigint").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/manifest/turn={(batch_id + 1) // self.keep % 2}")

    def merged(self, spark: SparkSession, before: int | None = None) -> int | None:
        """The last batch that the buckets hold; None if there are none yet."""
        found = [
            row.merged
            for turn in range(2)
            for row in self._read(spark, f"{self.path}/manifest/turn={turn}", "merged bigint")
        ]
        return max((b for b in found if before is None or b < before), default=None)

    @staticmethod
    def _read(spark: SparkSession, folder: str, schema: str) -> list:
        try:
            return spark.read.schema(schema).parquet(folder).collect()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return []
            raise

    def folders(self, spark: SparkSession, last: int | None = None) -> tuple[int, list[str]]:
        """The last merged batch (-1: none), and what has to be read."""
        merged = self.merged(spark, last)
        sets = [] if merged is None else [self._bucket_set(merged)]
        merged = -1 if merged is None else merged
        newest = merged + 2 * self.keep if last is None else last
        return merged, sets + [self._change(b) for b in range(merged + 1, newest + 1)]

    def _rows(self, spark: SparkSession, last: int | None = None) -> DataFrame:
        merged, folders = self.folders(spark, last)
        # ring folders may be missing at first, and hold older batches later
        found = [folder for folder in folders if self._exists(spark, folder)]
        if not found:
            return spark.createDataFrame([], TOTALS)
        rows = spark.read.schema(TOTALS).option("recursiveFileLookup", True).parquet(*found)
        return rows.where(F.col("batch") >= merged)

    @staticmethod
    def _exists(spark: SparkSession, folder: str) -> bool:
        try:
            spark.read.schema(TOTALS).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def read(self, spark: SparkSession) -> DataFrame:
        return latest_totals(self._rows(spark))

    def compact(self, spark: SparkSession, target: str) -> TotalsStore:
        """Write the current totals as the only batch of a new store."""
        compacted = TotalsStore(target, self.keep, self.buckets)
        compacted.write_batch(self.read(spark), 0)
        return compacted


def line_totals(lines: DataFrame) -> DataFrame:
    """Running totals of typed lines, or of raw ones (a ``value`` column)."""
    return customer_totals(split_fields(lines) if "value" in lines.columns else lines)


def start_totals(
    lines: DataFrame, store: TotalsStore, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the store up to date; queries read it at any time."""
    return (
        line_totals(lines)
        .writeStream.outputMode("update")
        .queryName("customer_totals")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_SECOND))
        .foreachBatch(store.write_batch)
        .start()
    )


Publish = Callable[[DataFrame, DataFrame, int], None]


def show_answers(sales: DataFrame, cancellations: DataFrame, batch_id: int) -> None:
    """Print both answers; they hold a few rows per country."""
    print("Top Sales:", [tuple(row) for row in sales.collect()])
    print("Top Cancellations:", [tuple(row) for row in cancellations.collect()])


def start_top_customers(
    lines: DataFrame,
    countries: str,
    checkpoint: str,
    publish: Publish = show_answers,
    n: int = 5,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer both top-N questions for the listed countries at every trigger.

    A trigger hands over the customers that changed. The others are read from
    the state of the trigger before, as far as their country is on the list.
    """

    def answer(changed: DataFrame, batch_id: int) -> None:
        spark, now = changed.sparkSession, changed
        if batch_id:
            before = totals_from_state(spark, checkpoint, batch_id - 1)
            now = latest_totals(changed.unionByName(before))
        now = totals_for_countries(now, ",".join(dict.fromkeys(countries.split(",")))).persist()
        try:
            publish(top_sales(now, countries, n), top_cancellations(now, countries, n), batch_id)
        finally:
            now.unpersist()

    return (
        line_totals(lines)
        .writeStream.outputMode("update")
        .queryName("top_customers")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_SECOND))
        .foreachBatch(answer)
        .start()
    )
