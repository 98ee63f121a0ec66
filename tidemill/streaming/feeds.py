"""File-stream pipelines: typed parsing shared with batch, checkpointed sinks, drain helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, DataStreamWriter, StreamingQuery

from tidemill.functions.scalars import parse_price, parse_us_date, parse_volume
from tidemill.operators.windows import running_sum

PRICES = ["Open", "Close", "High", "Low"]
FIELDS = [*PRICES, "Volume"]

NESTED_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Entries", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
])
FLAT_SCHEMA = T.StructType([
    T.StructField(name, T.StringType()) for name in ("date", "alias", "Category", *FIELDS)
])


def json_stream(
    spark: SparkSession, path: str, schema: T.StructType, archive: str | None = None, files_per_trigger: int = 16
) -> DataFrame:
    """Stream of JSON documents, one or more lines each; read files are archived when a folder is given."""
    reader: DataStreamReader = (
        spark.readStream.schema(schema).option("multiLine", True).option("maxFilesPerTrigger", files_per_trigger)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def typed_bars(df: DataFrame) -> DataFrame:
    """Text fields to date, prices with two decimals and whole volumes; malformed values become null."""
    return df.select(
        parse_us_date(F.col("Date")).alias("Date"), "Category", "Stock_Alias",
        *[parse_price(F.col(c)).alias(c) for c in PRICES],
        parse_volume(F.col("Volume")).alias("Volume"),
    )


def nested_bars(documents: DataFrame) -> DataFrame:
    """Explode the entries of each document, open their JSON text and type the fields."""
    entry = documents.select("Date", F.explode_outer("Entries").alias("e"))
    data = F.from_json(F.try_element_at("e", F.lit("Data")), T.MapType(T.StringType(), T.StringType()))
    opened = entry.select(
        "Date", F.try_element_at("e", F.lit("Category")).alias("Category"),
        F.try_element_at("e", F.lit("Stock_Alias")).alias("Stock_Alias"), data.alias("d"),
    )
    return typed_bars(opened.select(
        "Date", "Category", "Stock_Alias", *[F.try_element_at("d", F.lit(f)).alias(f) for f in FIELDS]
    ))


def flat_bars(documents: DataFrame) -> DataFrame:
    renamed = documents.withColumnRenamed("date", "Date").withColumnRenamed("alias", "Stock_Alias")
    return typed_bars(renamed.select("Date", "Category", "Stock_Alias", *FIELDS))


def with_processing_time(df: DataFrame) -> DataFrame:
    """Time of the micro-batch that handled the row."""
    return df.withColumn("Processed", F.current_timestamp())


def append_batch(path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df):
    """``foreachBatch`` sink: each batch owns the folder ``batch_id=N``, so a replay overwrites its own rows."""

    def write(df: DataFrame, batch_id: int) -> None:
        transform(df).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_available_now(writer: DataStreamWriter, checkpoint: str, timeout: float | None = None) -> StreamingQuery:
    """Process everything that is there, commit, stop, and wait for the end."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finished = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if finished is False:
        query.stop()
        raise TimeoutError("the stream did not drain in time")
    return query


def start_periodic(writer: DataStreamWriter, checkpoint: str, every: str = "15 seconds") -> StreamingQuery:
    """Long-running form of the same pipeline."""
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def running_volume_batch(df: DataFrame) -> DataFrame:
    """Running sum of the volume within one micro-batch; its size is bounded by the files per trigger."""
    return running_sum(df, "Stock_Alias", ["Date"], "Volume", "Running_Volume")


def compact(spark: SparkSession, source: str, target: str, rows_per_file: int = 5_000_000) -> None:
    """Rewrite the many small files of an append sink as fewer large ones."""
    rows = spark.read.parquet(source)
    rows.repartitionByRange("Stock_Alias", "Date").write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(target)


def threshold_messages(df: DataFrame, key: str, value: str, lower: float, upper: float) -> DataFrame:
    """Stateless alerts for rows outside the two thresholds."""
    below, above = F.col(value) < lower, F.col(value) > upper
    side = F.when(below, f"below the lower threshold ({lower:.2f})").otherwise(f"above the upper threshold ({upper:.2f})")
    message = F.format_string("%s (%.2f) is %s", F.col(key), F.col(value).cast("double"), side)
    return df.filter(below | above).withColumn("alert", message)
