"""Invoice lines and purchase streams derived from the warehouse tables.

Only the tables behind the requested columns are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.schema import LINE_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _owned_orders(spark: SparkSession, sf_dir: str, with_country: bool) -> DataFrame:
    """Orders with their customer, and the customer's country if it is needed.

    Orders meet their owners before they meet the much longer line items, so
    only two shuffles are as long as orders and line items are. Which side is
    broadcast, if any, is left to the session's size limit.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if with_country:
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        owners = customer.join(nation, F.expr("c_nationkey = n_nationkey"))
        orders = orders.join(owners, F.expr("o_custkey = c_custkey"))
    return orders


def _cents(amount: Column) -> Column:
    """A positive amount rounded to hundredths, in plain arithmetic.

    Spark's own rounding goes through decimal text and settles some halfway
    cases the other way than the SQL these tables are checked with.
    """
    return F.floor(amount * 100 + 0.5) / 100


def _price() -> Column:
    return _cents(F.col("l_extendedprice") / F.col("l_quantity") / 100)


def _quantity() -> Column:
    sign = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
    return sign.otherwise(F.col("l_quantity")).cast("int")


def _invoice_date() -> Column:
    order = F.col("l_orderkey")
    return F.concat(
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.lit(" "),
        (order % 24).cast("string"),
        F.lit(":"),
        F.lpad(((order * 7) % 60).cast("string"), 2, "0"),
    )


def lines(
    spark: SparkSession,
    sf_dir: str,
    columns: list[str] = LINE_COLUMNS,
    lineitem: DataFrame | None = None,
) -> DataFrame:
    """Typed invoice lines; ``lineitem`` may be given as a stream.

    ``slot`` (see ``defective_lines``) is available as an extra column.
    """
    # Descriptions come from part, dates from orders, countries from nation.
    rows = table(spark, sf_dir, "lineitem") if lineitem is None else lineitem
    if {"InvoiceDate", "CustomerID", "Country"} & set(columns):
        orders = _owned_orders(spark, sf_dir, "Country" in columns)
        rows = rows.join(orders, F.expr("l_orderkey = o_orderkey"))
    if "Description" in columns:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        rows = rows.join(parts, F.expr("l_partkey = p_partkey"))
    derived = {
        "InvoiceNo": F.col("l_orderkey").cast("string"),
        "StockCode": F.concat(F.lit("P"), F.col("l_partkey").cast("string")),
        "Description": F.col("p_name") if "Description" in columns else None,
        "Quantity": _quantity(),
        "InvoiceDate": _invoice_date(),
        "UnitPrice": _price(),
        "CustomerID": F.col("o_custkey").cast("string"),
        "Country": F.col("n_name") if "Country" in columns else None,
        "slot": (
            F.col("l_orderkey") * 31 + F.col("l_partkey") * 7 + F.col("l_linenumber")
        )
        % 40,
    }
    return rows.select(*[derived[name].alias(name) for name in columns])


def raw_text(typed: DataFrame) -> DataFrame:
    """Each line as one CSV text in ``value``, with the description quoted."""
    quoted = F.concat(F.lit('"'), F.col("Description"), F.lit(', x"'))
    fields = [quoted if name == "Description" else F.col(name) for name in LINE_COLUMNS]
    return typed.select(
        F.concat_ws(",", *[field.cast("string") for field in fields]).alias("value")
    )


def raw_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """All lines as CSV text."""
    return raw_text(lines(spark, sf_dir, LINE_COLUMNS, lineitem))


def _field(intact: Column, defects: dict[int, Column | str]) -> Column:
    """A field as text, replaced in the lines whose slot has a defect for it."""
    chain = F
    for slot, damaged in defects.items():
        value = damaged if isinstance(damaged, Column) else F.lit(damaged)
        chain = chain.when(F.col("slot") == slot, value)
    return chain.otherwise(intact.cast("string"))


def defective_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as CSV text, a part of them damaged in a known way.

    The slot number of a line decides the damage, so the same table always
    gives the same text. Slots without an entry below stay intact.
    """
    typed = lines(spark, sf_dir, [*LINE_COLUMNS, "slot"])
    description, date = F.col("Description"), F.col("InvoiceDate")
    quoted = F.concat(F.lit('"'), description, F.lit(', x"'))
    with_quotes = F.concat(F.lit('"'), description, F.lit(', ""X"""'))
    short_year = F.concat(F.substr(date, F.lit(1), F.lit(6)), F.substr(date, F.lit(9)))
    fields = [
        _field(F.col("InvoiceNo"), {14: ""}),
        _field(F.col("StockCode"), {15: ""}),
        _field(quoted, {9: description, 17: with_quotes}),
        _field(F.col("Quantity"), {2: "x", 3: "2.5", 7: " 5 ", 8: "0", 16: "1"}),
        _field(date, {11: "", 12: short_year, 13: "short"}),
        _field(F.col("UnitPrice"), {4: "-1", 5: "NaN", 6: "0"}),
        _field(F.col("CustomerID"), {0: ""}),
        _field(F.col("Country"), {1: ""}),
    ]
    whole = F.concat_ws(",", *fields)
    too_short = F.concat_ws(",", *fields[:3])
    too_long = F.concat(whole, F.lit(",extra"))
    return typed.select(_field(whole, {9: too_short, 10: too_long}).alias("value"))


def hostile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines as CSV text, a part of them far longer than a parser expects.

    Slots 0 to 3 hold thousands of quotes, an odd or an even number of them,
    and slot 4 thirty thousand columns. The short typed lines are dealt out
    first: few tasks that read the tables would else hold all the long text.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    typed = lines(spark, sf_dir, [*LINE_COLUMNS, "slot"]).repartition(tasks, *LINE_COLUMNS)
    number, country = F.col("InvoiceNo"), F.col("Country")

    def quotes(count: int) -> Column:
        run = F.repeat(F.lit('"'), F.lit(count))
        return F.concat(number, F.lit(","), run, F.lit('x,y",'), country)

    wide = F.concat(number, F.repeat(F.lit(",n"), F.lit(29_999)))
    plain = F.concat_ws(",", *[F.col(name).cast("string") for name in LINE_COLUMNS])
    hostile = {0: quotes(4001), 1: quotes(4000), 2: quotes(40_001), 3: quotes(40_000), 4: wide}
    return typed.select(_field(plain, hostile).alias("value"))


def purchases(
    spark: SparkSession,
    sf_dir: str,
    events: DataFrame | None = None,
    dense: bool = False,
) -> DataFrame:
    """Typed purchases with an arrival time, one per event.

    ``dense`` squeezes the arrival times a thousandfold towards the start of
    2024, so that many lines of an invoice share a window. ``events`` may be
    given as a stream.
    """
    rows = table(spark, sf_dir, "events") if events is None else events
    arrival = F.col("ts")
    if dense:
        origin = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
        micros = F.floor(F.timestamp_diff("MICROSECOND", origin, arrival) / 1000)
        arrival = F.timestamp_add("MICROSECOND", micros.cast("bigint"), origin)
    user = F.col("user_id").cast("string")
    return rows.select(
        F.concat(F.lit("I"), user).alias("InvoiceNo"),
        F.when(F.col("event_type") == "error", -1 - F.col("event_id") % 5)
        .otherwise(1 + F.col("event_id") % 12)
        .cast("int")
        .alias("Quantity"),
        F.date_format("ts", "dd/MM/yyyy H:mm").alias("InvoiceDate"),
        _cents(F.col("value")).alias("UnitPrice"),
        user.alias("CustomerID"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string")).alias("Country"),
        arrival.alias("ts"),
        "event_id",
    )


def raw_purchases(typed: DataFrame) -> DataFrame:
    """Purchases as (value, ts) raw lines; every fiftieth event lacks its customer."""
    customer = F.when(F.col("event_id") % 50 == 7, "").otherwise(F.col("CustomerID"))
    fields = [
        F.col("InvoiceNo"),
        F.lit("P"),
        F.lit("event"),
        F.col("Quantity").cast("string"),
        F.col("InvoiceDate"),
        F.col("UnitPrice").cast("string"),
        customer,
        F.col("Country"),
    ]
    return typed.select(
        F.concat_ws(",", *fields).alias("value"), F.col("ts").cast("timestamp").alias("ts")
    )
