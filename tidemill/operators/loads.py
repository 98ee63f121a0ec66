"""Load strategies over plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """Rows of both, the staged row winning where the key is in both.

    The anti join keeps every untouched target row where it is. A key that is staged twice is refused, as a
    database refuses such a batch.
    """
    twice = staged.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"{key} is staged more than once")
    untouched = target.join(staged.select(key), key, "left_anti")
    return untouched.select(*target.columns).unionByName(staged.select(*target.columns))


def insert_ignore(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Add only the rows whose key is not there yet.

    Of batch rows with the same key the smallest by the other columns is added; null keys never meet.
    """
    fresh = rows.select(*target.columns).join(target.select(key), key, "left_anti")
    others = [c for c in target.columns if c != key]
    keyed = fresh.filter(F.col(key).isNotNull())
    one = keyed.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*") if others else keyed.distinct()
    return target.unionByName(one).unionByName(fresh.filter(F.col(key).isNull()))


def full_refresh(rows: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Replace the table at ``path`` by ``rows`` in a fixed column order."""
    rows.select(*columns).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.parquet(path)


def newer_than_loaded(source: DataFrame, target: DataFrame, key: str, day: str, as_of: str, months: int = 6) -> DataFrame:
    """Source rows after the last loaded day of their key; unseen keys go ``months`` back from ``as_of``."""
    last = target.groupBy(key).agg(F.max(day).alias("_last"))
    default = F.add_months(F.lit(as_of).cast("date"), -months)
    joined = source.join(last, key, "left").filter(F.col(day) > F.coalesce("_last", default))
    return joined.drop("_last")


def skip_processed(source: DataFrame, processed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of keys not processed yet, and the key list extended by them."""
    todo = source.join(processed.select(key), key, "left_anti")
    return todo, processed.select(key).union(todo.select(key)).distinct()


def lookback_days(now: Column, logical: Column, max_days: int = 92) -> Column:
    """Whole days from the logical time to now plus at least one, clamped to 0 .. ``max_days``."""
    seconds = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(logical.cast("timestamp"))
    days = F.floor(seconds / 86400)
    extra = F.lit(1)  # the hours left over never make up more than a day
    return F.least(F.greatest(days + extra, F.lit(0)), F.lit(max_days)).cast("int")


def lookback_filter(df: DataFrame, ts_col: str, now: str, logical: str, max_days: int = 92) -> DataFrame:
    now_ts = F.lit(now).cast("timestamp_ntz")
    days = lookback_days(now_ts, F.lit(logical).cast("timestamp_ntz"), max_days)
    day = F.col(ts_col).cast("date")
    return df.filter((day >= F.date_sub(now_ts.cast("date"), days)) & (F.col(ts_col) <= now_ts))


def merge_observations(df: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Per key the latest value of each field; a missing value never replaces a present one."""
    latest = F.struct(*order)
    merged = [F.max_by(f, F.when(F.col(f).isNotNull(), latest)).alias(f) for f in fields]
    return df.groupBy(*keys).agg(*merged)


def nest_by_date(df: DataFrame, day: str, key: str, fields: list[str], keys: DataFrame) -> DataFrame:
    """One document per date holding an entry for every key; absent values read "n/a".

    ``keys`` is the table of keys, columns ``key`` and Category, one row per key. Every document holds all of it
    by definition, so it is gathered into one row; each date first gathers the keys it has. Rows and keys without a
    key are left out: a document has no place for them.
    """
    df, keys = df.filter(F.col(key).isNotNull()), keys.filter(F.col(key).isNotNull())
    value = F.to_json(F.struct(*[F.coalesce(F.col(f), F.lit("n/a")).alias(f) for f in fields]))
    present = df.groupBy(day).agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), value))).alias("_have"))
    nothing = F.to_json(F.struct(*[F.lit("n/a").alias(f) for f in fields]))
    all_keys = keys.agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col("Category").alias("c")))).alias("_keys"))

    def entry(pair: Column) -> Column:
        return F.create_map(
            F.lit("Stock_Alias"), pair["k"], F.lit("Category"), pair["c"],
            F.lit("Data"), F.coalesce(F.try_element_at("_have", pair["k"]), nothing),
        )

    return present.join(F.broadcast(all_keys)).select(F.col(day).alias("Date"), F.transform("_keys", entry).alias("Entries"))
