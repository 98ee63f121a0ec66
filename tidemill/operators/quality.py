"""Data-quality checks that report in a single pass where possible."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column with its number of nulls, from one aggregate over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "null_count")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(child_key).isNotNull()).join(keys, F.col(child_key) == F.col("_parent"), "left_anti")


def add_sanity_flag(df: DataFrame, checks: list[Column], out: str = "sanity_check") -> DataFrame:
    """True only if every check is true; an unknown check counts as failed."""
    passed = reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in checks])
    return df.withColumn(out, passed)


def mask_rows(df: DataFrame, not_null: list[str], keep: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without nulls for which ``keep`` holds, and a one-row report on what was dropped."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in not_null])
    good = F.coalesce(complete & keep, F.lit(False))
    report = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(good).alias("kept_rows"),
        F.count_if(~good).alias("dropped_rows"),
    )
    return df.filter(good), report


def clean_nulls(df: DataFrame, rename: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Drop all-null, then any-null rows; all columns to text, some renamed; and a report of the classes."""
    n_null = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns])
    width = len(df.columns)
    report = df.select(n_null.alias("n")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("n") == width).alias("all_null_rows"),
        F.count_if((F.col("n") > 0) & (F.col("n") < width)).alias("some_null_rows"),
        F.count_if(F.col("n") == 0).alias("remaining_rows"),
    )
    cleaned = df.na.drop("any").select([F.col(c).cast("string").alias(rename.get(c, c)) for c in df.columns])
    return cleaned, report
