"""Window operators over panels (key x time).

A panel holds one row per key and time step, so the rows of one key are bounded by
the calendar and a plain partitioned window is enough. Raw rows that are not
bounded that way go through ``operators.ordering``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.scalars import AQI_BANDS, band_class, safe_ratio
from tidemill.operators.ordering import keyed_row_number


def relative_change(current: Column, window) -> Column:
    """Ratio to the previous row minus one; null when either is missing or the previous one is zero."""
    return F.try_divide(current, F.lag(current, 1).over(window)) - 1


def add_rates(df: DataFrame, key: str, order: str, denominator: str, numerators: dict[str, str]) -> DataFrame:
    """Rate and relative rate change per key for each numerator column."""
    window = Window.partitionBy(key).orderBy(order)
    for numerator, out in numerators.items():
        df = df.withColumn(out, safe_ratio(F.col(numerator), F.col(denominator)))
    return df.withColumns({f"{out}_change": relative_change(F.col(out), window) for out in numerators.values()})


def running_sum(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    window = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(window))


def half_day_averages(df: DataFrame, measures: list[str], prefix: str = "avg_") -> DataFrame:
    """Mean of the current and the 12 preceding rows of a day, kept for its 12th and 24th row."""
    by_hour = Window.partitionBy("day").orderBy("hour")
    frame = by_hour.rowsBetween(-12, 0)
    averages = {f"{prefix}{m}": F.avg(m).over(frame) for m in measures}
    numbered = df.withColumns({**averages, "row_number": F.row_number().over(by_hour)})
    return numbered.filter(F.col("row_number").isin(12, 24)).select("day", "hour", *averages, "row_number")


def danger_classes(df: DataFrame, null_class: int | None = 6) -> DataFrame:
    """Class 1 to 6 of each air-quality index present in ``df``."""
    present = {name: bands for name, bands in AQI_BANDS.items() if name in df.columns}
    classes = [band_class(F.col(n), b, null_class).alias(f"{n}_class") for n, b in present.items()]
    return df.select("day", "hour", *classes)


def percent_change(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    window = Window.partitionBy(key).orderBy(order)
    return df.withColumn(out, F.try_divide(F.col(value).cast("double"), F.lag(value).over(window)) - 1)


def rolling(df: DataFrame, key: str, order: str, value: str, size: int, how, out: str) -> DataFrame:
    """``how`` over the last ``size`` rows, null until that many values are there."""
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(1 - size, 0)
    full = F.count(value).over(frame) == size
    return df.withColumn(out, F.when(full, how(value).over(frame)))


def forward_fill(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    window = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})


def downsample(df: DataFrame, key: str, order: list[str], max_rows: int = 1000) -> DataFrame:
    """At most ``max_rows`` evenly spaced rows per key, for a line plot.

    Row numbers come from range partitions, so a hot key is numbered by many tasks.
    """
    numbered = keyed_row_number(df, [key], order, "_rn")
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    step = F.ceil(F.col("_n") / max_rows)
    return numbered.join(sizes, key).filter((F.col("_rn") - 1) % step == 0).drop("_rn", "_n")
