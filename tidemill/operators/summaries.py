"""Aggregations with a shape of their own: profiles, histograms, box plots, matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.joins import bounded
from tidemill.operators.ordering import exact_percentiles
from tidemill.session import stage


def describe_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles per column."""
    long = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v")
    moments = long.groupBy("column_name").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    quartiles = exact_percentiles(long, ["column_name"], "v", [0.25, 0.5, 0.75])
    marks = [F.col("marks")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    return moments.join(F.broadcast(quartiles), "column_name").select("column_name", "n", "mean", "std", "min", *marks, "max")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts over equal-width bins between the extremes; the last bin is closed, empty bins give zero."""
    bounds = df.agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    step = F.coalesce(F.floor(F.try_divide(F.col(column) - F.col("_lo"), width)), F.lit(0))  # one value only: first bin
    place = F.least(step, F.lit(bins - 1)).cast("int")
    counted = (
        df.filter(F.col(column).isNotNull()).join(F.broadcast(bounds)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    grid = bounds.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_hi")
    return grid.join(counted, "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("low"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )


def box_summary(df: DataFrame, key: str, value: str) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 interquartile ranges) and outliers per key."""
    quartiles = exact_percentiles(df, [key], value, [0.25, 0.5, 0.75]).select(
        key, *[F.col("marks")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return df.join(bounded(stage(quartiles, "quartiles")), key).groupBy(key, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def dedup_on_keys(df: DataFrame, keys: list[str], prefer: list[Column]) -> DataFrame:
    """One row per key: the first in the total order ``prefer``.

    Each task keeps only its best row per key before the shuffle, so a hot key never travels whole.
    """
    order = Window.partitionBy(*keys).orderBy(*prefer)
    return df.withColumn("_rn", F.row_number().over(order)).filter("_rn = 1").drop("_rn")


def class_share(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of the total per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    return counts.withColumn("share", F.col("n") / F.sum("n").over(whole))
