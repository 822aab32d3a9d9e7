"""Sales and cancellation totals per customer and country, and top-N answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.functions import text

def amount_columns(lines: DataFrame) -> DataFrame:
    """The four columns the totals need."""
    return lines.select("Quantity", "UnitPrice", "CustomerID", "Country")


def drop_missing_owner(lines: DataFrame, drop_blank: bool = False) -> DataFrame:
    """Drop lines without customer or country; a blank one counts as a value."""
    owned = lines.dropna(subset=["CustomerID", "Country"])
    if drop_blank:
        owned = owned.where("CustomerID != '' and Country != ''")
    return owned


def with_amount(lines: DataFrame) -> DataFrame:
    """Add ``total_price``; lines whose numbers do not parse are dropped.

    Text columns are parsed without trimming the quantity; typed columns are
    used as they are.
    """
    quantity, price = F.col("Quantity"), F.col("UnitPrice")
    if isinstance(lines.schema["Quantity"].dataType, T.StringType):
        quantity = text.whole_number(quantity)
    if isinstance(lines.schema["UnitPrice"].dataType, T.StringType):
        price = text.number(price)
    amount = quantity.cast("double") * price
    return lines.withColumn("total_price", amount).where(
        F.col("total_price").isNotNull() & ~F.isnan("total_price")
    )


def split_volume(lines: DataFrame) -> DataFrame:
    """Positive amounts are sales, negative ones cancellations, zero is neither."""
    amount = F.col("total_price")
    return lines.withColumn(
        "sales", F.when(amount > 0, amount).otherwise(F.lit(0.0))
    ).withColumn("cancellations", F.when(amount < 0, -amount).otherwise(F.lit(0.0)))


def customer_totals(lines: DataFrame, drop_blank: bool = False) -> DataFrame:
    """Totals per (CustomerID, Country), from lines with text or typed numbers.

    On a stream this is an unbounded keyed aggregate for update or complete
    mode. Partial sums are taken before the one shuffle, so a hot customer
    costs one row per task.
    """
    volumes = split_volume(
        with_amount(drop_missing_owner(amount_columns(lines), drop_blank))
    )
    return volumes.groupBy("CustomerID", "Country").agg(
        F.sum("sales").alias("sales"), F.sum("cancellations").alias("cancellations")
    )


def selected_countries(
    spark: SparkSession, argument: str, separator: str = ","
) -> DataFrame:
    """One row per non-empty item of the argument, repeats kept."""
    return spark.range(1).select(
        F.explode(text.argument_items(F.lit(argument), separator)).alias("Country")
    )


def totals_for_countries(
    totals: DataFrame, argument: str, separator: str = ","
) -> DataFrame:
    """Totals of the listed countries; a country listed twice counts twice.

    The list is also given as a plain condition, which Spark can move below
    the aggregation of ``totals`` and into the scan; a join stays above. Both
    are part of the plan, as long as the argument itself.
    """
    countries = selected_countries(totals.sparkSession, argument, separator)
    names = {name for name in argument.split(separator) if name}
    totals = totals.where(F.col("Country").isin(*names))
    return totals.join(countries, "Country").select(
        "CustomerID", "Country", "sales", "cancellations"
    )


def total_sales(totals: DataFrame) -> DataFrame:
    return totals.select("CustomerID", "Country", F.col("sales").alias("total_sales"))


def total_cancellations(totals: DataFrame) -> DataFrame:
    return totals.select(
        "CustomerID", "Country", F.col("cancellations").alias("total_cancellations")
    )


def first_n_by_country(rows: DataFrame, measure: str, n: int = 5) -> DataFrame:
    """The n largest per country, ties by CustomerID.

    Spark keeps only n rows per country and task before the shuffle.
    """
    order = Window.partitionBy("Country").orderBy(F.desc(measure), F.asc("CustomerID"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_sales(totals: DataFrame, countries: str, n: int = 5) -> DataFrame:
    """Top customers by sales in each of the listed countries."""
    return first_n_by_country(
        total_sales(totals_for_countries(totals, countries)), "total_sales", n
    )


def top_cancellations(totals: DataFrame, countries: str, n: int = 5) -> DataFrame:
    """Top customers by cancelled volume in each of the listed countries."""
    return first_n_by_country(
        total_cancellations(totals_for_countries(totals, countries)),
        "total_cancellations",
        n,
    )
