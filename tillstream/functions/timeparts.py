"""Hour of day taken from the invoice date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRAINING_DEFAULT_HOUR = -1.0
STREAMING_DEFAULT_HOUR = 0.0


def invoice_hour(invoice_date: Column, default: float) -> Column:
    """Number between offset 10 and the first ``:``; ``default`` if there is none.

    The offset is fixed, so an 8-character date yields its minutes.
    """
    after_date = F.substr(invoice_date, F.lit(11))
    return F.coalesce(
        F.substring_index(after_date, ":", 1).try_cast("double"), F.lit(default)
    )


def training_hour(invoice_date: Column) -> Column:
    return invoice_hour(invoice_date, TRAINING_DEFAULT_HOUR)


def streaming_hour(invoice_date: Column) -> Column:
    return invoice_hour(invoice_date, STREAMING_DEFAULT_HOUR)


def epoch_micros(ts: Column, data_type: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP or a zone-less TIMESTAMP_NTZ.

    A zone-less value is read as UTC whatever the session zone is.
    """
    if data_type == "timestamp_ntz":
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", origin, ts)
    return F.unix_micros(ts)
