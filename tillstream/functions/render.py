"""Message text for the output feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field order of the two record kinds on the feeds.
PURCHASE_FIELDS = ["InvoiceNo", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
INVOICE_FIELDS = [
    "invoiceNo",
    "avgUnitPrice",
    "minUnitPrice",
    "maxUnitPrice",
    "time",
    "numberItems",
    "lastUpdated",
    "lines",
    "customerId",
]


def record_text(name: str, columns: Sequence[Column]) -> Column:
    """``Name(field,field,...)``, with ``null`` for a missing field."""
    parts = [F.coalesce(column.cast("string"), F.lit("null")) for column in columns]
    return F.concat(F.lit(f"{name}("), F.concat_ws(",", *parts), F.lit(")"))


def render(name: str, fields: Sequence[str], style: str = "record") -> Column:
    """Feed value of a row, as record text or as a JSON object.

    The update time is written as epoch milliseconds in both styles.
    """
    columns = [
        F.unix_millis(field).alias(field) if field == "lastUpdated" else F.col(field)
        for field in fields
    ]
    if style == "record":
        return record_text(name, columns)
    if style == "json":
        return F.to_json(F.struct(*columns))
    raise ValueError(f"unknown style {style!r}, expected 'record' or 'json'")


def purchase_value(style: str = "record") -> Column:
    return render("Purchase", PURCHASE_FIELDS, style)


def invoice_value(style: str = "record") -> Column:
    return render("Invoice", INVOICE_FIELDS, style)
