"""Joins that need more than one ``join`` call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; counts no further and reads no column it can avoid."""
    return df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` after checking that it has at most ``max_rows`` rows; larger sides are returned unhinted."""
    return F.broadcast(df) if fits(df, max_rows) else df


def product_of_dimensions(left: DataFrame, right: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Every pair of two dimension tables, refused when the product would exceed ``max_rows``."""
    n_left, n_right = (d.select(F.lit(1)).limit(max_rows + 1).count() for d in (left, right))
    if n_left * n_right > max_rows:
        raise ValueError(f"a product of {n_left} x {n_right} or more rows exceeds {max_rows}")
    return left.crossJoin(F.broadcast(right))


def with_child_counts(df: DataFrame, key: str, child: DataFrame, child_key: str, conditions: dict[str, Column]) -> DataFrame:
    """Per row the number of rows of the child table that meet each condition, zero when there are none.

    Children are counted in one pass before the one join, so a hot parent costs one row.
    """
    counts = child.groupBy(F.col(child_key).alias("_key")).agg(*[F.count_if(c).alias(out) for out, c in conditions.items()])
    joined = df.join(counts, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumns({out: F.coalesce(out, F.lit(0).cast("long")) for out in conditions})


def not_in(df: DataFrame, column: str, excluded: DataFrame) -> DataFrame:
    """``column NOT IN (subquery)`` with its null rules.

    Nothing passes when the list holds a null; a null value passes only an empty list.
    """
    values = excluded.select(F.col(excluded.columns[0]).alias("_value")).distinct()
    facts = values.agg(
        F.count_if(F.col("_value").isNull()).alias("_nulls"), F.count(F.lit(1)).alias("_size")
    )
    survivors = df.join(values, F.col(column) == F.col("_value"), "left_anti").join(F.broadcast(facts))
    passes = (F.col("_size") == 0) | ((F.col("_nulls") == 0) & F.col(column).isNotNull())
    return survivors.filter(passes).drop("_nulls", "_size")


def pre_aggregated(df: DataFrame, key: str, **aggregates: Column) -> DataFrame:
    return df.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])


LOOKUP_ROWS = 1_000_000
LOOKUP_CHARS = 64_000_000


def salted_lookup(
    facts: DataFrame, table: DataFrame, key: str, spread_by: str, salts: int = 16, small_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """Join facts with a narrow table of unique text keys although one key may hold a large share of the facts.

    A table of checked size is broadcast. A larger one is repeated once per salt, and the facts of a
    key are dealt to the salts by the hash of another column.
    """
    size = table.select(F.length(key).alias("l")).limit(small_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum("l").alias("l")).first()
    if size["n"] <= small_rows and (size["l"] or 0) <= LOOKUP_CHARS:
        return facts.join(F.broadcast(table), key)
    dealt = facts.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")
