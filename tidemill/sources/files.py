"""File sources and sinks, with explicit schemas unless inference is asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str = CORRUPT, **options) -> DataFrame:
    """Permissive CSV scan; the text of a malformed row lands in ``corrupt_col``."""
    full = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return reader.options(**{"header": True, **options}).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, **options) -> DataFrame:
    """Permissive CSV scan whose column types are found by one more pass over the files."""
    return spark.read.options(**{"header": True, "inferSchema": True, "mode": "PERMISSIVE", **options}).csv(path)


def read_headerless(spark: SparkSession, path: str, names: list[str], keep: dict[int, str], sep: str = "\t") -> DataFrame:
    """Delimited scan without a header row: only the columns at the given places, renamed."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).csv(path, sep=sep, header=False)
    return raw.select([F.col(names[i]).alias(out) for i, out in keep.items()])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_month_partitions(df: DataFrame, path: str, day_col: str) -> None:
    """Lake table partitioned by month, so date filters prune folders."""
    df.withColumn("month", F.date_format(day_col, "yyyy-MM")).write.mode("overwrite").partitionBy("month").parquet(path)


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows per input and whether all inputs agree, without pulling counts to the driver."""
    counts = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("input"), "n_rows")
        counts = one if counts is None else counts.unionAll(one)
    same = counts.agg((F.min("n_rows") == F.max("n_rows")).alias("all_equal"))
    return counts.join(F.broadcast(same))
