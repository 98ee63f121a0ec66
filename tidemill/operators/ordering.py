"""Ranks and running sums over a whole table without a single-task window.

Rows are range-partitioned on a total order, so a hot key is spread over several
partitions. Each partition is numbered on its own; one small row per partition
(or per partition and key) carries the offset of everything before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.joins import bounded
from tidemill.session import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def ordered_segments(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Rows range-partitioned on ``order`` with ``_seg`` (partition) and ``_pos`` (0-based place in it).

    ``order`` must be a total order: that is what lets a hot value be split.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = stage(ranged.withColumn("_mid", F.monotonically_increasing_id()), "segments")
    return tagged.select(
        "*",
        F.shiftright("_mid", _ROW_BITS).alias("_seg"),
        F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_pos"),
    ).drop("_mid")


def _offsets_per_segment(segments: DataFrame, amount: Column, out: str) -> DataFrame:
    """Exclusive prefix of ``amount`` over segments; one row per partition, so a plain window is enough."""
    per_segment = segments.groupBy("_seg").agg(amount.alias("_amount"))
    before = Window.orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    return per_segment.select("_seg", F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias(out))


def global_row_number(df: DataFrame, order: list[str | Column], out: str = "row_number", start: int = 1) -> DataFrame:
    """``row_number() over (order by ...)`` for a whole table."""
    segments = ordered_segments(df, order)
    offsets = _offsets_per_segment(segments, F.count(F.lit(1)), "_before")
    return (
        segments.join(F.broadcast(offsets), "_seg")
        .withColumn(out, (F.col("_before") + F.col("_pos") + F.lit(start)).cast("long"))
        .drop("_seg", "_pos", "_before")
    )


def global_running_sum(df: DataFrame, order: list[str | Column], value: str, out: str = "running_sum") -> DataFrame:
    """Inclusive running sum of ``value`` over a whole table."""
    segments = ordered_segments(df, order)
    offsets = _offsets_per_segment(segments, F.sum(value), "_before")
    inside = Window.partitionBy("_seg").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (
        segments.withColumn("_inside", F.sum(value).over(inside))
        .join(F.broadcast(offsets), "_seg")
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_seg", "_pos", "_before", "_inside")
    )


def keyed_running_sum(
    df: DataFrame, keys: list[str], order: list[str | Column], value: str, out: str = "running_sum"
) -> DataFrame:
    """Running sum per key in which one hot key may span many partitions."""
    return _running_over_segments(ordered_segments(df, [*keys, *order]), keys, value, out)


def _running_over_segments(segments: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    per_key = segments.groupBy(*keys, "_seg").agg(F.sum(value).alias("_amount"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_key.select(*keys, "_seg", F.sum("_amount").over(before).alias("_before"))
    inside = Window.partitionBy(*keys, "_seg").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = segments.withColumn("_inside", F.sum(value).over(inside))
    total = F.when(
        F.col("_before").isNull() & F.col("_inside").isNull(), F.lit(None)
    ).otherwise(F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0)))
    return summed.join(carried, [*keys, "_seg"]).withColumn(out, total).drop("_seg", "_pos", "_before", "_inside")


def keyed_row_number(df: DataFrame, keys: list[str], order: list[str | Column], out: str = "row_number") -> DataFrame:
    """Row number per key in which one hot key may span many partitions."""
    counted = keyed_running_sum(df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one", out)
    return counted.drop("_one")


def exact_percentiles(df: DataFrame, keys: list[str], value: str, probs: list[float], out: str = "marks") -> DataFrame:
    """Interpolated percentiles per key as an array, for groups of any size.

    Values collapse to counts; a running sum of the counts says which value stands at each
    position, so no task ever holds the values of a whole group.
    """
    keys_or_all = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    counts = rows.filter(F.col(value).isNotNull()).groupBy(*keys_or_all, value).agg(F.count(F.lit(1)).alias("_c"))
    segments = ordered_segments(counts, [*keys_or_all, value])
    running = _running_over_segments(segments, keys_or_all, "_c", "_upto")
    totals = segments.groupBy(*keys_or_all).agg(F.sum("_c").alias("_n"))
    placed = running.join(bounded(totals) if keys else F.broadcast(totals), keys_or_all)

    def at(index: Column) -> Column:
        here = (F.col("_upto") - F.col("_c") <= index) & (index < F.col("_upto"))
        return F.max(F.when(here, F.col(value).cast("double")))

    spots = [(F.col("_n") - 1) * F.lit(p) for p in probs]
    found = placed.groupBy(*keys_or_all, "_n").agg(
        *[at(F.floor(h)).alias(f"_lo{i}") for i, h in enumerate(spots)], *[at(F.ceil(h)).alias(f"_hi{i}") for i, h in enumerate(spots)]
    )
    marks = [F.col(f"_lo{i}") + (h - F.floor(h)) * (F.col(f"_hi{i}") - F.col(f"_lo{i}")) for i, h in enumerate(spots)]
    return found.select(*keys, F.array(*marks).alias(out))
