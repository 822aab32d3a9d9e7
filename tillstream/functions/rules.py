"""Boolean rules over parsed lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(column: Column) -> Column:
    return column.isNull() | (column == "")


def is_wrong_purchase(corrupt: Column | None = None) -> Column:
    """True for a line with a missing field, an unusable number or a negative price."""
    price, quantity = F.col("UnitPrice"), F.col("Quantity")
    wrong = (
        is_blank(F.col("InvoiceNo"))
        | is_blank(F.col("InvoiceDate"))
        | is_blank(F.col("CustomerID"))
        | is_blank(F.col("Country"))
        | quantity.isNull()
        | price.isNull()
        | F.isnan(price)
        | (price < 0)
    )
    return wrong if corrupt is None else wrong | corrupt


def is_cancellation() -> Column:
    return F.coalesce(F.col("Quantity") < 0, F.lit(False))


def is_training_line() -> Column:
    """Lines a model may learn from; CustomerID is not required."""
    return (
        (F.col("InvoiceNo") != "")
        & (F.col("StockCode") != "")
        & (F.col("InvoiceDate") != "")
        & (F.col("Country") != "")
        & (F.col("Quantity") > 1)
        & (F.col("UnitPrice") > 0)
        & ~F.isnan("UnitPrice")
        & ~F.isnan("Hour")
    )
