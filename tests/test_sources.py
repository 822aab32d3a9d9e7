"""CSV reading, text and Kafka sources, sinks, work folders and the command line."""

import pytest

from tillstream import session as sessions
from tillstream.__main__ import main
from tillstream.schema import LINE_COLUMNS
from tillstream.sources import files, kafka, tables
from tillstream.sources.sinks import FileSink, KafkaSink

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def test_csv_keeps_types(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text(
        HEADER
        + '\n536365,85123A,"A, ""B""",6,01/12/2010 8:26,2.55,17850,France'
        + "\n536366,85123A,x,many,,2.55,,France\n"
    )
    good, bad = files.read_invoice_csv(spark, str(path)).collect()
    assert good.InvoiceNo == "536365" and good.Description == 'A, "B"'
    assert (good.Quantity, good.UnitPrice, good.CustomerID, good.Hour) == (6, 2.55, "17850", 8.0)
    assert (bad.Quantity, bad.CustomerID, bad.Hour) == (None, None, -1.0)
    assert files.read_invoice_csv(spark, str(path)).columns == [*LINE_COLUMNS, "Hour"]


def test_text_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("1,a\n2,b\n")
    stream = files.stream_text(spark, str(folder), max_files=5)
    query = (
        stream.writeStream.format("memory").queryName("text_lines").trigger(availableNow=True)
    ).start()
    query.awaitTermination()
    rows = spark.table("text_lines").collect()
    assert sorted(row.value for row in rows) == ["1,a", "2,b"]
    assert all(row.ts is not None for row in rows)


def test_kafka_options():
    options = kafka.kafka_options(
        "h:9092", " a, b ,", from_beginning=True, max_offsets_per_trigger=20
    )
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "20",
    }
    assert kafka.kafka_options("h", "a", min_partitions=64)["minPartitions"] == "64"
    assert kafka.kafka_options("h", "a")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka.kafka_options("h", " , ")


def test_file_sink_replaces_a_repeated_batch(spark, tmp_path, rows):
    sink = FileSink(str(tmp_path))
    feed = spark.createDataFrame([("t", "k", "v")], "topic string, key string, value string")
    for batch_id in (0, 1, 1):
        sink.write_batch(feed, "t", batch_id)
    assert rows(sink.read(spark, "t")) == [("t", "k", "v")] * 2
    assert not hasattr(KafkaSink("h:9092"), "folder")


def test_work_folders(spark, monkeypatch):
    first, second = sessions.work_dir(spark, "x"), sessions.work_dir(spark, "x")
    assert first != second and first.startswith(sessions.checkpoint_root(spark))
    table = sessions.materialize(spark.range(5))
    assert table.count() == 5

    class Cluster:
        class conf:
            get = staticmethod(lambda name, default=None: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        sessions.checkpoint_root(Cluster)


def test_join_sides_follow_the_limit(spark):
    """Nothing is broadcast above the limit."""
    name, columns = "spark.sql.autoBroadcastJoinThreshold", ["Quantity", "Country"]
    before = spark.conf.get(name)

    def plan():
        lines = tables.lines(spark, "/root/testdata/sf0.001", columns)
        return lines._jdf.queryExecution().executedPlan().toString()

    try:
        spark.conf.set(name, "10MB")
        assert "SortMergeJoin" not in plan()
        spark.conf.set(name, "-1")
        assert "BroadcastHashJoin" not in plan() and "SortMergeJoin" in plan()
    finally:
        spark.conf.set(name, before)


def test_headered_csv_drops_headers_and_survives_wide_lines(spark, tmp_path):
    good = '1,s,"a, ""b""",2,01/12/2010 8:05,1.5,c,France'
    header = ",".join(LINE_COLUMNS)
    wide = good + ",n" * 30_000
    for name, lines in {"a": [good, ",".join("n" * 30_000), wide], "b": [good, ""]}.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *lines]))
    found = files.read_invoice_csv(spark, str(tmp_path)).collect()
    # fields beyond the eighth change nothing, however many there are
    assert [r.Description for r in found if r.InvoiceNo == "1"] == ['a, "b"'] * 3
    assert [r.Quantity for r in found if r.InvoiceNo == "1"] == [2] * 3
    assert [r.Quantity for r in found if r.InvoiceNo != "1"] == [None]


def test_command_line(spark, tmp_path, capsys):
    source = tmp_path / "lines.csv"
    lines = [
        f'{i % 40},s,"a, b",{2 + i % 3},01/12/2010 {i % 9}:05,{1 + i % 7},c{i % 4},France'
        for i in range(400)
    ]
    source.write_text("\n".join([HEADER, *lines]) + "\n")
    for family, name in (("kMeans", "km"), ("BisKMeans", "bis")):
        main(["train", str(source), str(tmp_path / name), str(tmp_path / f"{name}_t"), family])
    assert "selected kMeans model: k =" in capsys.readouterr().out

    incoming = tmp_path / "incoming"
    incoming.mkdir()
    (incoming / "a.txt").write_text("\n".join([*lines[:50], "bad,line"]) + "\n")
    main(
        ["detect", "--kmeans", str(tmp_path / "km"), str(tmp_path / "km_t")]
        + ["--bisecting", str(tmp_path / "bis"), str(tmp_path / "bis_t")]
        + ["--folder", str(incoming), "--output", str(tmp_path / "feeds"), "--at-once"]
        + ["--checkpoint", str(tmp_path / "detect")]
    )
    wrong = FileSink(str(tmp_path / "feeds")).read(spark, "facturas_erroneas").collect()
    assert [row.key for row in wrong] == ["bad"]

    main(
        ["top", "France", "5", "--folder", str(incoming), "--at-once"]
        + ["--checkpoint", str(tmp_path / "top")]
    )
    shown = capsys.readouterr().out
    assert "Top Sales: [('c" in shown and "Top Cancellations: [(" in shown
    with pytest.raises(SystemExit):
        main(["top", "France", "5", "--checkpoint", str(tmp_path / "x")])
