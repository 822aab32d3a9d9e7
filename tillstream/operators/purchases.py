"""Raw lines to typed purchases, and the feeds that need no state.

Every function takes and returns a batch or a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.functions import rules, text
from tillstream.functions.render import purchase_value
from tillstream.schema import LINE_COLUMNS, MALFORMED_TOPIC


def with_line_key(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add the message key of each raw line."""
    return lines.withColumn("key", text.line_key(F.col(value)))


def parse_purchases(lines: DataFrame, value: str = "value") -> DataFrame:
    """Replace the raw text column by the eight typed columns and two flags.

    ``is_corrupt`` marks a wrong field count and ``is_wrong`` any malformed
    line. All other input columns, such as ``key`` and ``ts``, pass through.
    """
    kept = [name for name in lines.columns if name != value]
    # As a generator the parser runs once per line. As a plain column, filters
    # on its fields would be pushed below it and parse the line again.
    fields = lines.select(*kept, F.inline(F.array(text.csv_record(F.col(value)))))
    typed = {
        "Quantity": text.whole_number(F.trim("Quantity")),
        "UnitPrice": text.number(F.trim("UnitPrice")),
    }
    parsed = fields.select(
        *kept,
        *[typed.get(name, F.col(name)).alias(name) for name in LINE_COLUMNS],
        F.col(text.CORRUPT).isNotNull().alias("is_corrupt"),
    )
    return parsed.withColumn("is_wrong", rules.is_wrong_purchase(F.col("is_corrupt")))


def split_fields(lines: DataFrame, value: str = "value") -> DataFrame:
    """Replace the raw text column by the eight fields as they are written.

    Quotes stay, a blank field is ``""`` and a missing one is NULL.
    """
    kept = [name for name in lines.columns if name != value]
    # One generated row per line, for the same reason as in parse_purchases.
    split = F.array(text.split_outside_quotes(F.col(value), len(LINE_COLUMNS) + 1))
    fields = lines.select(*kept, F.explode(split).alias("fields"))
    return fields.select(
        *kept,
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(LINE_COLUMNS)],
    )


def malformed(purchases: DataFrame) -> DataFrame:
    return purchases.where("is_wrong")


def well_formed(purchases: DataFrame) -> DataFrame:
    """Lines that may be aggregated; cancellations are among them."""
    return purchases.where("not is_wrong")


def cancelled(purchases: DataFrame) -> DataFrame:
    """Every line with a negative quantity, malformed ones included."""
    return purchases.where(rules.is_cancellation())


def malformed_feed(purchases: DataFrame, style: str = "record") -> DataFrame:
    """(topic, key, value) rows for the malformed lines."""
    return malformed(purchases).select(
        F.lit(MALFORMED_TOPIC).alias("topic"),
        F.col("key"),
        purchase_value(style).alias("value"),
    )
