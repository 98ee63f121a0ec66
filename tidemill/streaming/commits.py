"""Several tables written by one micro-batch and published together by one commit record.

Each table has a folder per batch. The record of a batch is written when all its folders are there, and readers see the
batches with a record only. A batch that failed in between leaves folders without a record; its replay has the same
number, writes the same folders anew and then the record, so every table holds the batch once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = "_commits"


def append_tables(root: str, data: str, derived: dict[str, Callable[[DataFrame], DataFrame]]):
    """``foreachBatch`` sink: the batch goes to table ``data``; each derived table is computed from what was written.

    Reading the written batch keeps the tables in step even where the source would give other rows a second time.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        df.write.mode("overwrite").parquet(f"{root}/{data}/batch_id={batch_id}")
        inserted = spark.read.schema(df.schema).parquet(f"{root}/{data}/batch_id={batch_id}")
        for name, rows in derived.items():
            rows(inserted).write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")
        record = spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.array(*[F.lit(n) for n in (data, *derived)]).alias("tables"))
        record.write.mode("overwrite").parquet(f"{root}/{RECORDS}/{batch_id}")

    return write


def committed(spark: SparkSession, root: str) -> DataFrame:
    """Numbers of the published batches and the tables they wrote."""
    return spark.read.option("recursiveFileLookup", True).schema("batch_id long, tables array<string>").parquet(f"{root}/{RECORDS}")


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of the published batches of one table, with their batch_id."""
    published = committed(spark, root).filter(F.array_contains("tables", table)).select(F.col("batch_id").alias("_published")).distinct()
    rows = spark.read.parquet(f"{root}/{table}").withColumn("batch_id", F.col("batch_id").cast("long"))
    return rows.join(published, F.col("batch_id") == F.col("_published"), "left_semi")
