"""Command line: train a model, run live detection, answer the top customers.

    python -m tillstream train lines.csv model threshold kMeans
    python -m tillstream detect --kmeans model threshold --bisecting model2 threshold2 \\
        --servers host:9092 --topics purchases --checkpoint /shared/detection
    python -m tillstream top "France,Portugal" 60 --folder incoming --checkpoint /shared/top

Lines come from Kafka (--servers, --topics) or from text files dropped into
--folder. Feeds go back to Kafka, or to parquet folders under --output.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from tillstream.operators import clusters
from tillstream.plans import models, training
from tillstream.schema import BISECTING_ANOMALIES_TOPIC, KMEANS_ANOMALIES_TOPIC
from tillstream.session import build_session
from tillstream.sources import files, kafka
from tillstream.sources.sinks import FileSink, KafkaSink
from tillstream.streaming import detection, totals
from tillstream.streaming.staging import every_second
from tillstream.streaming.windows import DEFAULT_DELAY_SECONDS


def _add_source(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--servers", help="Kafka servers to read from")
    parser.add_argument("--topics", help="comma-separated topics")
    parser.add_argument("--folder", help="folder of text files to read instead")
    parser.add_argument(
        "--max-per-trigger", type=int, help="most offsets or files to read in one trigger"
    )
    parser.add_argument("--checkpoint", required=True, help="shared folder for progress")
    parser.add_argument("--at-once", action="store_true", help="stop when all input is read")


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.at_once else {"processingTime": "1 second"}


def _lines(spark, args: argparse.Namespace, from_beginning: bool):
    if args.folder:
        return files.stream_text(spark, args.folder, args.max_per_trigger)
    if not (args.servers and args.topics):
        raise SystemExit("give --folder, or --servers and --topics")
    return kafka.stream_kafka(
        spark,
        servers=args.servers,
        topics=args.topics,
        from_beginning=from_beginning,
        max_offsets_per_trigger=args.max_per_trigger,
    )


def train(spark, args: argparse.Namespace) -> None:
    outcome = training.run(
        spark, args.source, args.model, args.threshold, args.family,
        max_k=args.max_k, ratio=args.ratio, offset=args.offset, rank=args.rank,
    )
    print(f"selected {args.family} model: k = {outcome.model.k}")


def detect(spark, args: argparse.Namespace) -> None:
    scorers = {
        KMEANS_ANOMALIES_TOPIC: models.load_model_and_threshold(spark, *args.kmeans),
        BISECTING_ANOMALIES_TOPIC: models.load_model_and_threshold(spark, *args.bisecting),
    }
    sink = FileSink(args.output) if args.output else KafkaSink(args.servers)
    lines = _lines(spark, args, from_beginning=False)
    if args.stamp_arrival:
        lines = lines.withColumn("ts", F.current_timestamp())
    job = detection.Detection(
        lines,
        sink,
        args.checkpoint,
        scorers,
        dedupe=args.dedupe,
        match_training_filter=args.match_training_filter,
        delay=args.delay,
        heartbeat=None if args.at_once or args.no_heartbeat else every_second(spark),
    )
    if args.at_once:
        job.run()
    else:
        for query in job.start(clean=args.clean):
            query.awaitTermination()
    late = job.late_lines()
    if late:
        print(f"{late} lines came too late for their windows; a larger --delay takes them in")


def top(spark, args: argparse.Namespace) -> None:
    query = totals.start_top_customers(
        _lines(spark, args, from_beginning=True),
        args.countries,
        args.checkpoint,
        trigger=_trigger(args),
    )
    if args.at_once:
        query.awaitTermination()
    else:
        query.awaitTermination(args.seconds)
        query.stop()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(
        prog="tillstream", description=__doc__, formatter_class=argparse.RawTextHelpFormatter
    )
    commands = parser.add_subparsers(required=True)

    command = commands.add_parser("train", help="train a model from a headered CSV")
    command.add_argument("source")
    command.add_argument("model")
    command.add_argument("threshold")
    command.add_argument("family", choices=[models.KMEANS, models.BISECTING_KMEANS])
    command.add_argument("--max-k", type=int, default=training.MAX_K)
    command.add_argument("--ratio", type=float, default=clusters.ELBOW_RATIO)
    command.add_argument("--offset", type=int, default=0, help="models after the elbow")
    command.add_argument("--rank", type=int, default=clusters.THRESHOLD_RANK)
    command.set_defaults(run=train)

    command = commands.add_parser("detect", help="run the live feeds")
    command.add_argument("--kmeans", nargs=2, required=True, metavar=("MODEL", "THRESHOLD"))
    command.add_argument("--bisecting", nargs=2, required=True, metavar=("MODEL", "THRESHOLD"))
    command.add_argument("--output", help="folder for the feeds instead of Kafka")
    command.add_argument("--dedupe", action="store_true", help="one alert per invoice")
    command.add_argument("--match-training-filter", action="store_true")
    command.add_argument(
        "--delay", type=int, default=DEFAULT_DELAY_SECONDS, help="seconds a line may be late"
    )
    command.add_argument(
        "--stamp-arrival", action="store_true", help="arrival is the time of reading: never late"
    )
    command.add_argument(
        "--no-heartbeat", action="store_true", help="counts wait while no lines come"
    )
    command.add_argument(
        "--clean", action="store_true", help="delete staged rows once the windows have read them"
    )
    _add_source(command)
    command.set_defaults(run=detect)

    command = commands.add_parser("top", help="print the top customers every second")
    command.add_argument("countries")
    command.add_argument("seconds", type=int)
    _add_source(command)
    command.set_defaults(run=top)

    args = parser.parse_args(argv)
    args.run(build_session("tillstream"), args)


if __name__ == "__main__":
    main()
