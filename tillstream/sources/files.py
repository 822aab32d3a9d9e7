"""File sources: headered CSV for training, text lines and tables as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.operators.features import with_hour
from tillstream.schema import LINE_COLUMNS, LINE_SCHEMA

_HEADER = ",".join(LINE_COLUMNS).lower()
_LINE_DDL = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in LINE_SCHEMA)
_CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}


def read_invoice_csv(spark: SparkSession, path: str) -> DataFrame:
    """Headered invoice CSV with fixed types and the hour added.

    Lines that name the columns are headers. A number that does not parse is
    read as NULL and fails the training rule. Fields beyond the eighth are left
    out, however many there are.
    """
    text_lines = spark.read.text(path)
    is_header = F.lower(F.replace("value", F.lit('"'), F.lit(""))) == _HEADER
    rows = text_lines.where(~is_header & (F.trim("value") != ""))
    line = F.col("value")
    record = F.when(text.is_wide(line), text.wide_fields(line)).otherwise(
        F.from_csv(line, _LINE_DDL, _CSV_OPTIONS)
    )
    # As a generator the parser runs once per line.
    lines = rows.select(F.explode(F.array(record)).alias("line")).select(
        *[F.col(f"line.{name}").alias(name) for name in LINE_COLUMNS]
    )
    return with_hour(lines)


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw lines from a folder that files are dropped into.

    The file time stands for the arrival time. ``max_files`` bounds a trigger.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("ts"))


def stream_table(
    spark: SparkSession,
    path: str,
    schema=None,
    max_files: int | None = None,
    clean: bool = False,
) -> DataFrame:
    """A parquet folder or file as a stream; the schema is fixed at the start.

    ``clean`` deletes files once they are read, for folders with one reader.
    """
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    # folders within are batches, whose names are no columns
    reader = reader.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if clean:
        reader = reader.option("cleanSource", "delete")
    # A plain stream path has to be a folder; a pattern may also name one file.
    folder, name = path.rstrip("/").rsplit("/", 1)
    return reader.parquet(f"{folder}/{{{name}}}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in any store that Spark reaches; a missing one is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
