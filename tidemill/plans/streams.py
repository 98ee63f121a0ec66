"""Streaming pipelines, each run until its source is drained and then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemill.operators import edits, loads
from tidemill.operators.ordering import keyed_running_sum
from tidemill.operators.summaries import dedup_on_keys
from tidemill.plans.loading import CATEGORY_SQL, alias_table, bar_texts, category_of
from tidemill.plans.registry import query
from tidemill.session import exists, scratch_path
from tidemill.sources.tables import BARS_SQL, day_text
from tidemill.streaming import commits, feeds

_CATEGORY = CATEGORY_SQL.format("ticker")
_BAR_FIELDS = f"""CAST(day AS VARCHAR) AS "Date", {_CATEGORY} AS "Category", ticker AS "Stock_Alias", open AS "Open",
    close AS "Close", high AS "High", low AS "Low", volume::DOUBLE AS "Volume\""""
_BARS_TYPED = f"SELECT {_BAR_FIELDS} FROM ({BARS_SQL})"
_GRID = f"""SELECT day, ticker, open, close, high, low, volume FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
    CROSS JOIN (SELECT DISTINCT event_type AS ticker FROM events) LEFT JOIN ({BARS_SQL}) USING (day, ticker)"""
_GRID_TYPED = f"SELECT {_BAR_FIELDS} FROM ({_GRID})"


def write_nested(t, path, when=None):
    """One nested document per file and date, as the feed delivers them."""
    texts = bar_texts(t.events if when is None else t.events.filter(when))
    nested = loads.nest_by_date(texts, "Date", "Stock_Alias", feeds.FIELDS, alias_table(t.events))
    nested.write.option("maxRecordsPerFile", 1).mode("append").json(path)


def write_flat(t, path, when=None):
    texts = bar_texts(t.events if when is None else t.events.filter(when))
    flat = texts.select(F.col("Date").alias("date"), F.col("Stock_Alias").alias("alias"), category_of("Stock_Alias").alias("Category"), *feeds.FIELDS)
    flat.write.option("maxRecordsPerFile", 1).mode("append").json(path)


def presentable(df):
    """Comparable types: ISO dates, doubles, no processing time and no batch number."""
    doubles = {c: F.col(c).cast("double") for c in feeds.FIELDS if c in df.columns}
    return df.withColumns({"Date": day_text("Date"), **doubles}).drop("Processed", "batch_id")


def nested_source(t, archive=False, when=None):
    source = scratch_path(t.spark, "nested")
    write_nested(t, source, when)
    stream = feeds.json_stream(t.spark, source, feeds.NESTED_SCHEMA, scratch_path(t.spark, "archive") if archive else None)
    return source, feeds.with_processing_time(feeds.nested_bars(stream))


def drain_batches(t, stream, transform=lambda df: df, target=None, checkpoint=None):
    target = target or scratch_path(t.spark, "lake")
    checkpoint = checkpoint or scratch_path(t.spark, "progress")
    feeds.run_available_now(stream.writeStream.foreachBatch(feeds.append_batch(target, transform)), checkpoint)
    return t.spark.read.parquet(target)


def drain_native(t, stream, target=None, checkpoint=None):
    target = target or scratch_path(t.spark, "lake")
    checkpoint = checkpoint or scratch_path(t.spark, "progress")
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", target)
    feeds.run_available_now(writer, checkpoint)
    return t.spark.read.parquet(target)


@query("stream_nested_json", _GRID_TYPED)
def stream_nested_json(t):
    """Nested documents, archived after reading, through the typed chain."""
    _, stream = nested_source(t, archive=True)
    return presentable(drain_batches(t, stream))


@query("stream_flat_json", _BARS_TYPED)
def stream_flat_json(t):
    source = scratch_path(t.spark, "flat")
    write_flat(t, source)
    stream = feeds.flat_bars(feeds.json_stream(t.spark, source, feeds.FLAT_SCHEMA))
    return presentable(drain_native(t, feeds.with_processing_time(stream)))


@query("stream_foreachbatch_append", f"""
    SELECT "Stock_Alias", count("Volume") AS n_volumes, sum("Volume")::DOUBLE AS volume FROM ({_GRID_TYPED}) GROUP BY 1""")
def stream_foreachbatch_append(t):
    _, stream = nested_source(t)
    lake = presentable(drain_batches(t, stream))
    return lake.groupBy("Stock_Alias").agg(F.count("Volume").alias("n_volumes"), F.sum("Volume").alias("volume"))


@query("stream_append_sink", _GRID_TYPED)
def stream_append_sink(t):
    _, stream = nested_source(t)
    return presentable(drain_native(t, stream))


@query("stream_restart", _BARS_TYPED)
def stream_restart(t):
    """Two runs over one checkpoint with new files in between; nothing is read twice."""
    source, target, checkpoint = (scratch_path(t.spark, n) for n in ("flat", "lake", "progress"))
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        write_flat(t, source, part)
        stream = feeds.flat_bars(feeds.json_stream(t.spark, source, feeds.FLAT_SCHEMA, files_per_trigger=64))
        lake = drain_batches(t, stream, target=target, checkpoint=checkpoint)
    return presentable(lake)


@query("stream_running_volume", f"""
    SELECT "Date", "Stock_Alias", "Volume",
      sum("Volume") OVER (PARTITION BY "Stock_Alias" ORDER BY "Date" ROWS UNBOUNDED PRECEDING) AS "Running_Volume" FROM ({_GRID_TYPED})""")
def stream_running_volume(t):
    """Rows are stored by the stream; the table-wide running volume is computed when they are read."""
    _, stream = nested_source(t)
    lake = drain_batches(t, stream).select("Date", "Stock_Alias", "Volume")
    summed = keyed_running_sum(lake, ["Stock_Alias"], ["Date"], "Volume", "Running_Volume")
    return presentable(summed).withColumn("Running_Volume", F.col("Running_Volume").cast("double"))


@query("stream_running_volume_batch")
def stream_running_volume_batch(t):
    """Running volume restarted in every micro-batch, which depends on how files fall into batches."""
    _, stream = nested_source(t)
    lake = drain_batches(t, stream, feeds.running_volume_batch)
    return presentable(lake).withColumn("Running_Volume", F.col("Running_Volume").cast("double"))


@query("stream_dedup", _GRID_TYPED)
def stream_dedup(t):
    """The feed delivers every document twice; the reader keeps one row per alias and date."""
    source, stream = nested_source(t)
    write_nested(t, source)
    lake = drain_batches(t, stream)
    kept = dedup_on_keys(lake, ["Stock_Alias", "Date"], [F.col("Processed"), F.col("batch_id")])
    return presentable(kept)


@query("stream_threshold_alerts", f"""
    SELECT CAST(day AS VARCHAR) AS "Date", ticker AS "Stock_Alias", printf('%s (%.2f) is %s', ticker, close, CASE WHEN close < 5
      THEN 'below the lower threshold (5.00)' ELSE 'above the upper threshold (120.00)' END) AS alert
    FROM ({BARS_SQL}) WHERE close < 5 OR close > 120""")
def stream_threshold_alerts(t):
    _, stream = nested_source(t)
    alerts = feeds.threshold_messages(stream, "Stock_Alias", "Close", 5.0, 120.0)
    return presentable(drain_native(t, alerts)).select("Date", "Stock_Alias", "alert")


def audit_messages(inserted):
    """One fixed message, one with a value and one by a condition for each inserted row."""
    trend = F.when(F.col("Close") > F.col("Open"), "added rising bar").when(F.col("Close") < F.col("Open"), "added falling bar").otherwise("added other bar")
    return edits.audit_rows(inserted, F.explode(F.array(F.lit("added new bar"), F.concat(F.lit("alias "), F.col("Stock_Alias")), trend)))


@query("stream_audit_log", f"""
    WITH b AS ({_BARS_TYPED})
    SELECT 'added new bar' AS message, count(*) AS n FROM b UNION ALL SELECT 'alias ' || "Stock_Alias", count(*) FROM b GROUP BY 1
    UNION ALL SELECT CASE WHEN "Close" > "Open" THEN 'added rising bar' WHEN "Close" < "Open" THEN 'added falling bar' ELSE 'added other bar' END, count(*) FROM b GROUP BY 1
    UNION ALL SELECT 'bars stored', count(*) FROM b""")
def stream_audit_log(t):
    """Bars and their audit rows, written by the same micro-batches under one commit record; every batch is replayed."""
    source, root = scratch_path(t.spark, "flat"), scratch_path(t.spark, "lake")
    write_flat(t, source)
    stream = feeds.flat_bars(feeds.json_stream(t.spark, source, feeds.FLAT_SCHEMA, files_per_trigger=64))
    write = commits.append_tables(root, "bars", {"audit": audit_messages})

    def twice(df, batch_id):
        write(df, batch_id)
        write(df, batch_id)

    feeds.run_available_now(stream.writeStream.foreachBatch(twice), scratch_path(t.spark, "progress"))
    stored = commits.read_committed(t.spark, root, "bars").agg(F.lit("bars stored").alias("message"), F.count(F.lit(1)).alias("n"))
    return commits.read_committed(t.spark, root, "audit").groupBy("message").agg(F.count(F.lit(1)).alias("n")).unionAll(stored)


def _files_below(spark, folder):
    """Names of the JSON files below a folder."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(folder)
    return listed.select("path", "length")


@query("stream_archive_counts", """
    SELECT count(DISTINCT CAST(ts AS DATE)) AS n_files, count(DISTINCT CAST(ts AS DATE)) AS n_once FROM events""")
def stream_archive_counts(t):
    """Files of the feed after it has been drained with archiving on: each is in one place, source or archive, and none is lost.

    Spark archives the files of a batch after the next one, so where the last ones lie depends on the batches.
    """
    source, archive = scratch_path(t.spark, "nested"), scratch_path(t.spark, "archive")
    write_nested(t, source)
    stream = feeds.nested_bars(feeds.json_stream(t.spark, source, feeds.NESTED_SCHEMA, archive))
    drain_batches(t, stream)
    name = F.element_at(F.split("path", "/"), -1)
    both = reduce(lambda a, b: a.unionAll(b), [_files_below(t.spark, f).select(name.alias("file")) for f in (source, archive) if exists(t.spark, f)])
    per_file = both.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("n_files"), F.count_if(F.col("n") == 1).alias("n_once"))


@query("stream_processing_time", f"SELECT count(*) AS n_rows, true AS within_run, true AS one_time_a_batch FROM ({_BARS_TYPED})")
def stream_processing_time(t):
    """Every row carries the time of its micro-batch: one for each batch, between start and end of the run."""
    source = scratch_path(t.spark, "flat")
    write_flat(t, source)
    now = lambda: t.spark.range(1).select(F.current_timestamp()).first()[0]
    started = now()
    lake = drain_batches(t, feeds.with_processing_time(feeds.flat_bars(feeds.json_stream(t.spark, source, feeds.FLAT_SCHEMA, files_per_trigger=64))))
    ended = now()
    per_batch = lake.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("Processed").alias("lo"), F.max("Processed").alias("hi"))
    inside = F.bool_and((F.col("lo") >= F.lit(started)) & (F.col("hi") <= F.lit(ended)))
    return per_batch.agg(F.sum("n").alias("n_rows"), inside.alias("within_run"), F.bool_and(F.col("lo") == F.col("hi")).alias("one_time_a_batch"))
