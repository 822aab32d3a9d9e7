"""Named queries over the warehouse tables, one or more per operator.

Each takes a session and a table folder and returns a DataFrame. Numbers that
come from floating-point sums are rounded, so that results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions import text
from tillstream.functions.timeparts import streaming_hour, training_hour
from tillstream.operators import clusters, features, purchases, totals, windows
from tillstream.plans import models, training
from tillstream.plans.models import BISECTING_KMEANS, KMEANS, ClusterModel
from tillstream.schema import (
    BISECTING_ANOMALIES_TOPIC,
    CANCELLATIONS_TOPIC,
    FEATURE_COLUMNS,
    KMEANS_ANOMALIES_TOPIC,
    LATE_TOPIC,
    LINE_COLUMNS,
    MALFORMED_TOPIC,
)
from tillstream.session import streaming_session, work_dir
from tillstream.sources import files, tables
from tillstream.sources.sinks import TAIL, FileSink
from tillstream.streaming import detection
from tillstream.streaming import totals as live_totals
from tillstream.streaming.staging import Staging

Query = Callable[[SparkSession, str], DataFrame]

COUNTRIES = "NATION_3,NATION_7,,NATION_12,NATION_3"

# Centroids of the frozen models, in feature order.
FIXED_CENTERS = (
    (22.0, 10.0, 40.0, 12.0, 60.0),
    (80.0, 8.0, 250.0, 12.0, 90.0),
    (30.0, 12.0, 60.0, 12.0, 140.0),
    (26.0, 20.0, 32.0, 12.0, 25.0),
    (130.0, 12.0, 420.0, 12.0, 80.0),
    (35.0, 6.0, 110.0, 12.0, 190.0),
)
SCORING_CENTERS = FIXED_CENTERS[:3]
WINDOW_MODELS = {
    KMEANS_ANOMALIES_TOPIC: (
        ClusterModel(KMEANS, [[30.0, 25.0, 40.0, 12.0, 6.0], [120.0, 90.0, 150.0, 12.0, 8.0]]),
        9000.0,
    ),
    BISECTING_ANOMALIES_TOPIC: (
        ClusterModel(BISECTING_KMEANS, [[50.0, 40.0, 60.0, 12.0, 7.0]]),
        20000.0,
    ),
}

AT_ONCE = {"availableNow": True}


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases.parse_purchases(
        purchases.with_line_key(tables.defective_lines(spark, sf_dir))
    )


def _comparable(parsed: DataFrame) -> DataFrame:
    """NaN prices as NULL plus a flag."""
    return parsed.withColumn(
        "price_is_nan", F.coalesce(F.isnan("UnitPrice"), F.lit(False))
    ).withColumn("UnitPrice", F.nanvl("UnitPrice", F.lit(None).cast("double")))


def _typed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.lines(spark, sf_dir)


def parse_lines_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_parsed(spark, sf_dir))


def split_csv_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases.split_fields(tables.defective_lines(spark, sf_dir))


def parse_hostile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the overlong lines are malformed."""
    keyed = purchases.with_line_key(tables.hostile_lines(spark, sf_dir))
    return purchases.parse_purchases(keyed).select("key", "is_wrong")


def split_hostile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the overlong lines, long ones by their digest."""
    fields = purchases.split_fields(tables.hostile_lines(spark, sf_dir))
    digests = {n: F.when(F.length(n) > 100, F.md5(n)).otherwise(F.col(n)) for n in LINE_COLUMNS}
    return fields.withColumns(digests)


def _hours(spark: SparkSession, sf_dir: str, hour) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return parsed.select("key", "InvoiceDate", hour(F.col("InvoiceDate")).alias("Hour"))


def hour_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hours(spark, sf_dir, training_hour)


def hour_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hours(spark, sf_dir, streaming_hour)


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = purchases.split_fields(tables.defective_lines(spark, sf_dir))
    return totals.with_amount(totals.drop_missing_owner(totals.amount_columns(fields)))


def line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(spark, sf_dir).withColumn("total_price", F.round("total_price", 2))


def split_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = totals.split_volume(_amounts(spark, sf_dir))
    return split.select(
        "CustomerID",
        "Country",
        F.round("total_price", 2).alias("total_price"),
        F.round("sales", 2).alias("sales"),
        F.round("cancellations", 2).alias("cancellations"),
    )


AMOUNT_COLUMNS = ["Quantity", "UnitPrice", "CustomerID", "Country"]


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals.customer_totals(tables.lines(spark, sf_dir, AMOUNT_COLUMNS))


def _rounded_totals(rows: DataFrame) -> DataFrame:
    return rows.select(
        "CustomerID",
        "Country",
        F.round("sales", 2).alias("sales"),
        F.round("cancellations", 2).alias("cancellations"),
    )


def customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_totals(_totals(spark, sf_dir))


def customer_totals_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From damaged text, with blank customers and countries as groups."""
    return _rounded_totals(live_totals.line_totals(tables.defective_lines(spark, sf_dir)))


def customer_totals_without_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = purchases.split_fields(tables.defective_lines(spark, sf_dir))
    return _rounded_totals(totals.customer_totals(fields, drop_blank=True))


def selected_country_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_totals(totals.totals_for_countries(_totals(spark, sf_dir), COUNTRIES))


def top_sales_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = totals.top_sales(_totals(spark, sf_dir), COUNTRIES)
    return top.withColumn("total_sales", F.round("total_sales", 2))


def top_cancellations_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = totals.top_cancellations(_totals(spark, sf_dir), COUNTRIES)
    return top.withColumn("total_cancellations", F.round("total_cancellations", 2))


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(purchases.malformed(_parsed(spark, sf_dir)))


def valid_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(purchases.well_formed(_parsed(spark, sf_dir)))


def cancelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(purchases.cancelled(_parsed(spark, sf_dir)))


def malformed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases.malformed_feed(_parsed(spark, sf_dir))


def training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.training_lines(features.with_hour(_parsed(spark, sf_dir)))
    return rows.select(*LINE_COLUMNS, "Hour")


FEATURE_INPUT = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice", "Country"]


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tables.lines(spark, sf_dir, FEATURE_INPUT)
    return features.training_features(features.with_hour(lines))


def _rounded_features(rows: DataFrame) -> DataFrame:
    return rows.withColumn("AvgUnitPrice", F.round("AvgUnitPrice", 8))


def invoice_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_features(_features(spark, sf_dir))


def feature_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_features(features.preview(_features(spark, sf_dir)))


def load_invoice_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headered CSV round trip of all lines, read back with fixed types."""
    folder = work_dir(spark, "csv")
    _typed_lines(spark, sf_dir).write.option("header", True).csv(folder)
    return files.read_invoice_csv(spark, folder)


def _windows(spark: SparkSession, sf_dir: str, dense: bool) -> DataFrame:
    return windows.invoice_windows(tables.purchases(spark, sf_dir, dense=dense))


def _rounded_windows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("avgUnitPrice", F.round("avgUnitPrice", 8)).withColumn(
        "lastUpdated", F.unix_micros("lastUpdated")
    )


def invoice_windows_40s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_windows(_windows(spark, sf_dir, dense=False))


def invoice_windows_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows with many lines in each."""
    return _rounded_windows(_windows(spark, sf_dir, dense=True))


def cancellations_trailing_8min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.trailing_counts(purchases.cancelled(tables.purchases(spark, sf_dir)))


def cancellations_every_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = purchases.cancelled(tables.purchases(spark, sf_dir, dense=True))
    return windows.every_second(windows.trailing_counts(rows))


def cancellation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detection.cancellation_feed(cancellations_every_second(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.score_literal(_features(spark, sf_dir), SCORING_CENTERS)


def distance_fixed_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    return rows.select("InvoiceNo", "prediction", F.round("distance", 6).alias("distance"))


def fixed_centers_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = clusters.clustering_cost(_scored(spark, sf_dir))
    return cost.select(F.round("cost", 2).alias("cost"))


def threshold_top2000(spark: SparkSession, sf_dir: str) -> DataFrame:
    threshold = clusters.distance_threshold(_scored(spark, sf_dir))
    return threshold.select(F.round("threshold", 6).alias("threshold"))


def anomalies_fixed_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    rows = clusters.anomalies(scored, clusters.distance_threshold(scored))
    return rows.select("InvoiceNo", "prediction", F.round("distance", 6).alias("distance"))


def single_cluster_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = clusters.single_cluster(_features(spark, sf_dir))
    return row.select(
        *[F.round(name, 6).alias(name) for name in FEATURE_COLUMNS],
        F.round("cost", 1).alias("cost"),
    )


def codebook_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = clusters.codebook_costs(_features(spark, sf_dir), FIXED_CENTERS)
    return costs.select("k", F.round("cost", 1).alias("cost"))


def elbow_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.elbow_table(clusters.codebook_costs(_features(spark, sf_dir), FIXED_CENTERS))


def _window_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalous windows of both models, each under its topic."""
    invoices = _windows(spark, sf_dir, dense=True)
    feeds = [
        detection.anomalous_invoices(invoices, model, threshold).withColumn(
            "topic", F.lit(topic)
        )
        for topic, (model, threshold) in WINDOW_MODELS.items()
    ]
    return feeds[0].unionByName(feeds[1])


def window_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_alerts(spark, sf_dir).select(
        "topic", "invoiceNo", "tick", "prediction", F.round("distance", 6).alias("distance")
    )


def first_anomaly_per_invoice(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, threshold = WINDOW_MODELS[KMEANS_ANOMALIES_TOPIC]
    invoices = _windows(spark, sf_dir, dense=True)
    alerts = detection.anomalous_invoices(invoices, model, threshold)
    first = windows.first_alert_per_invoice(alerts)
    return first.select("invoiceNo", "tick", F.round("distance", 6).alias("distance"))


def _saved_and_loaded(
    spark: SparkSession, model: ClusterModel, threshold: float
) -> tuple[ClusterModel, float]:
    folder = work_dir(spark, "model")
    models.save_model(spark, model, f"{folder}/model")
    models.save_threshold(spark, threshold, f"{folder}/threshold")
    return models.load_model_and_threshold(spark, f"{folder}/model", f"{folder}/threshold")


def _judged(rows: DataFrame, limit: float, digits: int) -> DataFrame:
    return rows.select(
        "InvoiceNo",
        "prediction",
        F.round("distance", digits).alias("distance"),
        (F.col("distance") > limit).alias("is_anomaly"),
        (F.col("distance") >= limit).alias("is_ranked"),
    )


def reloaded_single_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job up to k = 1, whose model is the mean: saved, loaded and applied."""
    lines = tables.lines(spark, sf_dir, FEATURE_INPUT)
    outcome, threshold, scored = training.train(lines, KMEANS, max_k=1)
    model, limit = _saved_and_loaded(spark, outcome.model, threshold)
    return _judged(model.score(scored.drop("prediction", "distance")), limit, 2)


def reloaded_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored centroids and their threshold, loaded and applied to every invoice."""
    rows = _features(spark, sf_dir)
    centers = ClusterModel(BISECTING_KMEANS, [list(center) for center in SCORING_CENTERS])
    threshold = clusters.distance_threshold(centers.score(rows)).first().threshold
    model, limit = _saved_and_loaded(spark, centers, threshold)
    return _judged(model.score(rows), limit, 6)


def _train_and_score(spark: SparkSession, sf_dir: str, family: str) -> DataFrame:
    """Train, save, load again and score the training invoices."""
    lines = tables.lines(spark, sf_dir, FEATURE_INPUT)
    outcome, threshold, scored = training.train(lines, family)
    model, limit = _saved_and_loaded(spark, outcome.model, threshold)
    rows = model.score(scored.drop("prediction", "distance"))
    return rows.select(
        "InvoiceNo",
        "prediction",
        F.round("distance", 6).alias("distance"),
        (F.col("distance") > limit).alias("is_anomaly"),
        F.lit(model.k).alias("k"),
    )


def kmeans_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_and_score(spark, sf_dir, KMEANS)


def bisecting_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _train_and_score(spark, sf_dir, BISECTING_KMEANS)


def _line_stream(session: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as they arrive, joined with the standing tables."""
    lineitem = files.stream_table(session, f"{sf_dir}/lineitem.parquet")
    return tables.lines(session, sf_dir, AMOUNT_COLUMNS, lineitem)


def _purchase_stream(session: SparkSession, sf_dir: str) -> DataFrame:
    events = files.stream_table(session, f"{sf_dir}/events.parquet")
    rows = tables.purchases(session, sf_dir, events, dense=True)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_customer_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    session, folder = streaming_session(spark), work_dir(spark, "totals")
    store = live_totals.TotalsStore(f"{folder}/log")
    live_totals.start_totals(
        _line_stream(session, sf_dir), store, f"{folder}/checkpoint", AT_ONCE
    ).awaitTermination()
    return _rounded_totals(store.read(spark))


def _asked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both answers, asked of the state of a totals query."""
    session, folder = streaming_session(spark), work_dir(spark, "answers")
    store = live_totals.TotalsStore(f"{folder}/log")
    checkpoint = f"{folder}/checkpoint"
    live_totals.start_totals(
        _line_stream(session, sf_dir), store, checkpoint, AT_ONCE
    ).awaitTermination()
    return live_totals.top_customers(session, checkpoint, COUNTRIES)


def stream_top_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, _ = _asked(spark, sf_dir)
    return sales.withColumn("total_sales", F.round("total_sales", 2))


def stream_top_cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, cancellations = _asked(spark, sf_dir)
    return cancellations.withColumn("total_cancellations", F.round("total_cancellations", 2))


def _staged(session: SparkSession, sf_dir: str, folder: str) -> Staging:
    """All purchases staged by a run that has ended."""
    staging = Staging(f"{folder}/staging")
    staging.start(_purchase_stream(session, sf_dir), f"{folder}/lines", AT_ONCE).awaitTermination()
    staging.close(session)
    return staging


def stream_invoice_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window: those the stream has closed, and those open at its end."""
    session, folder = streaming_session(spark), work_dir(spark, "windows")
    sink, staging = FileSink(f"{folder}/sink"), _staged(session, sf_dir, folder)

    def publish(spans: DataFrame, batch_id: int) -> None:
        sink.write_batch(windows.spread(spans), "windows", batch_id)

    staging.start_invoice_windows(
        session, f"{folder}/checkpoint", AT_ONCE, publish
    ).awaitTermination()
    publish(staging.open_invoice_windows(session), TAIL)
    return _rounded_windows(sink.read(spark, "windows"))


def stream_cancellations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trailing count: those the stream has closed, and those open at its end."""
    session, folder = streaming_session(spark), work_dir(spark, "counts")
    sink, staging = FileSink(f"{folder}/sink"), _staged(session, sf_dir, folder)
    counts = staging.trailing_counts(session)
    counts = counts.select(F.unix_seconds("tick").alias("tick"), "n")
    sink.start(counts, "counts", f"{folder}/checkpoint", AT_ONCE).awaitTermination()
    sink.write_batch(staging.open_counts(session), "counts", TAIL)
    return sink.read(spark, "counts")


def stream_cancellations_every_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts; no second is missing between the first and the last."""
    return windows.with_empty_ticks(stream_cancellations(spark, sf_dir))


def _feeds(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Everything published after running all feeds on raw lines."""
    session, folder = streaming_session(spark), work_dir(spark, "detection")
    sink = FileSink(f"{folder}/feeds")
    lines = tables.raw_purchases(_purchase_stream(session, sf_dir))
    detection.Detection(lines, sink, f"{folder}/checkpoint", WINDOW_MODELS, **options).run()
    topics = [MALFORMED_TOPIC, CANCELLATIONS_TOPIC, LATE_TOPIC, *WINDOW_MODELS]
    return spark.read.schema(detection.FEED_SCHEMA).parquet(
        *[f"{sink.folder(topic)}/batch=*" for topic in topics]
    )


def stream_detection_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per feed and key after running all feeds on raw lines."""
    return _feeds(spark, sf_dir).groupBy("topic", "key").agg(F.count(F.lit(1)).alias("messages"))


def stream_first_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts per topic and invoice if each invoice is to be reported once."""
    alerts = _feeds(spark, sf_dir, dedupe=True).where(F.col("topic").isin(list(WINDOW_MODELS)))
    return alerts.groupBy("topic", "key").agg(F.count(F.lit(1)).alias("messages"))


def message_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per message key of the raw text."""
    rows = tables.raw_lines(spark, sf_dir)
    keys = rows.select(text.line_key(F.col("value")).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("lines"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        message_keys,
        parse_lines_typed,
        split_csv_fields,
        parse_hostile_lines,
        split_hostile_lines,
        hour_training,
        hour_streaming,
        line_amounts,
        split_volume,
        customer_totals,
        customer_totals_from_text,
        customer_totals_without_blanks,
        selected_country_totals,
        top_sales_by_country,
        top_cancellations_by_country,
        malformed_lines,
        valid_lines,
        cancelled_lines,
        malformed_feed,
        load_invoice_csv,
        training_lines,
        invoice_features,
        feature_preview,
        invoice_windows_40s,
        invoice_windows_dense,
        cancellations_trailing_8min,
        cancellations_every_second,
        cancellation_feed,
        distance_fixed_centers,
        fixed_centers_cost,
        threshold_top2000,
        anomalies_fixed_centers,
        single_cluster_baseline,
        codebook_costs,
        elbow_choice,
        window_anomalies,
        first_anomaly_per_invoice,
        reloaded_single_model,
        reloaded_centers,
        kmeans_train_score,
        bisecting_train_score,
        stream_customer_totals,
        stream_top_sales,
        stream_top_cancellations,
        stream_invoice_windows,
        stream_cancellations,
        stream_cancellations_every_second,
        stream_detection_feeds,
        stream_first_anomalies,
    )
}
