"""Where feed rows (topic, key, value) go."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


#: Batch of what is still open when a bounded run ends; streams never get so far.
TAIL = (1 << 62) - 1


@dataclass(frozen=True)
class KafkaSink:
    """Each row goes to the topic it names. Delivery is at least once."""

    servers: str

    def write_batch(self, feed: DataFrame, name: str, batch_id: int) -> None:
        feed.write.format("kafka").option("kafka.bootstrap.servers", self.servers).save()

    def start(self, feed: DataFrame, name: str, checkpoint: str, trigger: dict) -> StreamingQuery:
        return (
            feed.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .option("checkpointLocation", checkpoint)
            .queryName(name)
            .trigger(**trigger)
            .start()
        )


@dataclass(frozen=True)
class FileSink:
    """One parquet folder per feed and batch. A batch that is run again replaces
    its own folder, so each row is kept exactly once."""

    path: str

    def folder(self, name: str) -> str:
        return f"{self.path}/{name}"

    def write_batch(self, feed: DataFrame, name: str, batch_id: int) -> None:
        feed.write.mode("overwrite").parquet(f"{self.folder(name)}/batch={batch_id}")

    def withdraw(self, spark: SparkSession, name: str, batch_id: int) -> None:
        """Empty the folder of a batch, if there is one."""
        folder = f"{self.folder(name)}/batch={batch_id}"
        try:
            written = spark.read.parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            nothing = spark.createDataFrame([], written.schema)
            nothing.write.mode("overwrite").parquet(folder)

    def start(self, feed: DataFrame, name: str, checkpoint: str, trigger: dict) -> StreamingQuery:
        return (
            feed.writeStream.option("checkpointLocation", checkpoint)
            .queryName(name)
            .trigger(**trigger)
            .foreachBatch(lambda rows, batch_id: self.write_batch(rows, name, batch_id))
            .start()
        )

    def read(self, spark, name: str) -> DataFrame:
        """Everything written to a feed so far."""
        return spark.read.parquet(self.folder(name)).drop("batch")
