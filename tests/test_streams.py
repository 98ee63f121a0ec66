"""File streams: typing of odd documents, restart, replay, archiving, periodic trigger."""

import datetime as dt
import json
import os
import time

import pytest

from tidemill.streaming import feeds


def document(path, name, date, entries):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump({"Date": date, "Entries": entries}, f, indent=1)


def entry(alias, **fields):
    return {"Stock_Alias": alias, "Category": "Companies", "Data": json.dumps(fields)}


def drain(spark, source, target, checkpoint, **options):
    stream = feeds.nested_bars(feeds.json_stream(spark, source, feeds.NESTED_SCHEMA, **options))
    feeds.run_available_now(stream.writeStream.foreachBatch(feeds.append_batch(target)), checkpoint)
    return spark.read.parquet(target)


@pytest.fixture
def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("source", "target", "checkpoint", "archive")}


def test_odd_documents(spark, paths):
    document(paths["source"], "a.json", "3/7/2024", [entry("BAYN.DE", Open="1,285.50", Close="n/a", High="", Volume="67,175,000")])
    document(paths["source"], "b.json", "12/07/2024", [])
    document(paths["source"], "c.json", "3/17/2024", [entry("AMZN", Open="1234.5", Volume="-1")])
    rows = {r["Date"]: r for r in drain(spark, paths["source"], paths["target"], paths["checkpoint"]).collect()}
    first = rows[dt.date(2024, 3, 7)]
    assert (float(first["Open"]), first["Close"], first["High"], first["Low"], int(first["Volume"])) == (1285.5, None, None, None, 67175000)
    assert rows[dt.date(2024, 12, 7)]["Stock_Alias"] is None
    assert rows[dt.date(2024, 3, 17)]["Open"] is None and rows[dt.date(2024, 3, 17)]["Volume"] is None


def test_restart_reads_only_new_files(spark, paths):
    document(paths["source"], "a.json", "1/1/2024", [entry("A", Volume="1")])
    assert drain(spark, paths["source"], paths["target"], paths["checkpoint"]).count() == 1
    document(paths["source"], "b.json", "1/2/2024", [entry("A", Volume="2")])
    assert drain(spark, paths["source"], paths["target"], paths["checkpoint"]).count() == 2
    assert drain(spark, paths["source"], paths["target"], paths["checkpoint"]).count() == 2


def test_replayed_batch_overwrites_itself(spark, paths):
    write = feeds.append_batch(paths["target"])
    batch = spark.range(5)
    write(batch, 0)
    write(batch, 0)
    write(batch, 1)
    assert spark.read.parquet(paths["target"]).count() == 10


def test_archive_moves_committed_files(spark, paths):
    for i in range(3):
        document(paths["source"], f"{i}.json", f"1/{i + 1}/2024", [entry("A", Volume="1")])
    drain(spark, paths["source"], paths["target"], paths["checkpoint"], archive=paths["archive"], files_per_trigger=1)
    archived = [f for _, _, files in os.walk(paths["archive"]) for f in files if f.endswith(".json")]
    assert archived and len(archived) + len(os.listdir(paths["source"])) == 3


def test_running_volume_restarts_in_each_batch(spark, paths):
    for i in range(3):
        document(paths["source"], f"{i}.json", f"1/{i + 1}/2024", [entry("A", Volume="10")])
    stream = feeds.nested_bars(feeds.json_stream(spark, paths["source"], feeds.NESTED_SCHEMA, files_per_trigger=1))
    sink = feeds.append_batch(paths["target"], feeds.running_volume_batch)
    feeds.run_available_now(stream.writeStream.foreachBatch(sink), paths["checkpoint"])
    assert [int(r[0]) for r in spark.read.parquet(paths["target"]).select("Running_Volume").collect()] == [10, 10, 10]


def test_periodic_trigger_and_compaction(spark, paths, tmp_path):
    document(paths["source"], "a.json", "1/1/2024", [entry("A", Volume="1")])
    stream = feeds.nested_bars(feeds.json_stream(spark, paths["source"], feeds.NESTED_SCHEMA))
    query = feeds.start_periodic(stream.writeStream.format("parquet").option("path", paths["target"]), paths["checkpoint"], "1 second")
    try:
        deadline = time.time() + 60
        query.processAllAvailable()
        assert time.time() < deadline
    finally:
        query.stop()
    compacted = str(tmp_path / "compacted")
    feeds.compact(spark, paths["target"], compacted)
    assert spark.read.parquet(compacted).count() == 1


def test_alert_text(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 50.0), ("C", 200.0)], "k string, v double")
    out = {r["k"]: r["alert"] for r in feeds.threshold_messages(df, "k", "v", 5, 120).collect()}
    assert out == {"A": "A (1.00) is below the lower threshold (5.00)", "C": "C (200.00) is above the upper threshold (120.00)"}
