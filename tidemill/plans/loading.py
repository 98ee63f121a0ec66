"""Scans, sinks and load strategies."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.hashing import unit_hash, unit_hash_sql
from tidemill.operators import loads, quality
from tidemill.plans.registry import query
from tidemill.plans.sets import entry_properties, explode_entries
from tidemill.session import scratch_path
from tidemill.sources import files
from tidemill.sources.tables import BARS_SQL, EVENT_TYPES, HOURLY_SQL, POLLUTANTS, daily_bars, day_text, hourly_measures


@query("csv_permissive_scan", """
    SELECT c_custkey, c_name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal END AS c_acctbal, c_mktsegment,
           c_mktsegment = 'FURNITURE' AS is_corrupt FROM customer""")
def csv_permissive_scan(t):
    path = scratch_path(t.spark, "customer-csv")
    bad = F.col("c_mktsegment") == "FURNITURE"
    balance = F.when(bad, F.lit("not a number")).otherwise(F.col("c_acctbal").cast("string"))
    files.write_csv(t.customer.select("c_custkey", "c_name", balance.alias("c_acctbal"), "c_mktsegment"), path)
    schema = T.StructType().add("c_custkey", "long").add("c_name", "string").add("c_acctbal", "double").add("c_mktsegment", "string")
    scan = files.read_csv(t.spark, path, schema)
    return scan.withColumn("is_corrupt", F.col(files.CORRUPT).isNotNull()).drop(files.CORRUPT)


@query("csv_inferred_scan", """
    SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
           'int,string,double,int' AS found_types FROM orders""")
def csv_inferred_scan(t):
    path = scratch_path(t.spark, "orders-csv")
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    files.write_csv(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", customer.alias("o_custkey")), path)
    scan = files.read_csv_inferred(t.spark, path)
    types = ",".join("int" if kind == "bigint" else kind for _, kind in scan.dtypes)
    return scan.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")}).withColumn("found_types", F.lit(types))


@query("headerless_tsv_scan", "SELECT n_name AS name, CAST(n_regionkey AS VARCHAR) AS region FROM nation")
def headerless_tsv_scan(t):
    path = scratch_path(t.spark, "nation-tsv")
    t.nation.select("n_nationkey", "n_name", "n_regionkey").write.csv(path, sep="\t", header=False)
    return files.read_headerless(t.spark, path, ["a", "b", "c"], {1: "name", 2: "region"})


@query("row_count_reconcile", """
    WITH c AS (SELECT 'orders' AS input, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
               UNION ALL SELECT 'customer', count(*) FROM customer)
    SELECT input, n_rows, (SELECT count(DISTINCT n_rows) = 1 FROM c) AS all_equal FROM c""")
def row_count_reconcile(t):
    return files.row_counts({"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer})


@query("csv_overwrite_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_overwrite_roundtrip(t):
    path = scratch_path(t.spark, "supplier-csv")
    files.write_csv(t.supplier, path)
    files.write_csv(t.supplier, path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in t.supplier.schema.fields])
    return files.read_csv(t.spark, path, schema).drop(files.CORRUPT)


@query("staging_replace", "SELECT r_regionkey, lower(r_name) AS r_name FROM region")
def staging_replace(t):
    path = scratch_path(t.spark, "region-stage")
    t.region.write.mode("overwrite").parquet(path)
    t.region.withColumn("r_name", F.lower("r_name")).write.mode("overwrite").parquet(path)
    return t.spark.read.parquet(path)


def staged_customers(t):
    """A staging batch: changed balances for one segment and new keys for another."""
    changed = t.customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    new = t.customer.filter("c_mktsegment = 'MACHINERY'").withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)
    return changed.unionByName(new)


@query("upsert_by_key", """
    SELECT c_custkey, c_mktsegment, round(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END, 4) AS c_acctbal FROM customer
    UNION ALL SELECT c_custkey + 1000000000, c_mktsegment, round(c_acctbal, 4) FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def upsert_by_key(t):
    merged = loads.upsert(t.customer, staged_customers(t), "c_custkey")
    return merged.select("c_custkey", "c_mktsegment", F.round("c_acctbal", 4).alias("c_acctbal"))


@query("insert_ignore", """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
    UNION ALL SELECT c_custkey + 1000000000, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY'""")
def insert_ignore(t):
    return loads.insert_ignore(t.customer, staged_customers(t), "c_custkey").select("c_custkey", "c_mktsegment", "c_acctbal")


@query("full_refresh", "SELECT n_regionkey, n_name, n_nationkey FROM nation")
def full_refresh(t):
    path = scratch_path(t.spark, "nation-refresh")
    loads.full_refresh(t.nation.limit(0), path, t.nation.columns)
    return loads.full_refresh(t.nation, path, ["n_regionkey", "n_name", "n_nationkey"])


@query("incremental_new_rows", f"""
    WITH b AS (SELECT ticker, day, close FROM ({BARS_SQL})),
    l AS (SELECT ticker, max(day) AS last_day FROM b WHERE day < DATE '2024-01-15' AND ticker <> 'view' AND (ticker <> 'click' OR day < DATE '2024-01-08') GROUP BY 1)
    SELECT ticker, CAST(day AS VARCHAR) AS day, close FROM b LEFT JOIN l USING (ticker)
    WHERE day > coalesce(last_day, (DATE '2024-07-20' - INTERVAL 6 MONTH)::DATE)""")
def incremental_new_rows(t):
    bars = daily_bars(t.events).select("ticker", "day", "close")
    loaded = bars.filter("day < DATE '2024-01-15' AND ticker <> 'view' AND (ticker <> 'click' OR day < DATE '2024-01-08')")
    return loads.newer_than_loaded(bars, loaded, "ticker", "day", "2024-07-20").withColumn("day", day_text("day"))


@query("skip_processed_keys", """
    WITH p AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'),
    todo AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM p))
    SELECT o_custkey, count(*) AS n_todo FROM todo GROUP BY 1 UNION ALL SELECT o_custkey, 0 FROM p""")
def skip_processed_keys(t):
    processed = t.orders.filter("o_orderstatus = 'P'").select("o_custkey").distinct()
    todo, recorded = loads.skip_processed(t.orders, processed, "o_custkey")
    counts = todo.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_todo"))
    return recorded.join(counts, "o_custkey", "left").na.fill(0, ["n_todo"])


@query("backfill_lookback", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-28' - 12 AND ts <= TIMESTAMP '2024-01-28 09:00:00'""")
def backfill_lookback(t):
    recent = loads.lookback_filter(t.events, "ts", "2024-01-28 09:00:00", "2024-01-16 21:00:00")
    return recent.select("event_id", day_text("ts").alias("day"))


@query("merge_partial_observations", """
    WITH o AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS value,
                      CASE WHEN event_type <> 'view' THEN event_type END AS kind FROM events)
    SELECT user_id, CAST(day AS VARCHAR) AS day, arg_max(value, (ts, event_id)) FILTER (value IS NOT NULL) AS value,
           arg_max(kind, (ts, event_id)) FILTER (kind IS NOT NULL) AS kind FROM o GROUP BY user_id, o.day""")
def merge_partial_observations(t):
    observed = t.events.select(
        "user_id", day_text("ts").alias("day"), "ts", "event_id",
        F.when(F.col("event_type") != "error", F.col("value")).alias("value"),
        F.nullif("event_type", F.lit("view")).alias("kind"),
    )
    return loads.merge_observations(observed, ["user_id", "day"], ["ts", "event_id"], ["value", "kind"])


CATEGORIES = {"click": "traffic", "view": "traffic", "error": "health", "purchase": "money", "signup": "money"}
CATEGORY_SQL = "CASE {0} " + " ".join(f"WHEN '{k}' THEN '{c}'" for k, c in CATEGORIES.items()) + " ELSE 'other' END"


def category_of(alias):
    """Category of an alias; those that no category names are in "other"."""
    known = F.create_map(*[F.lit(x) for pair in CATEGORIES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.col(alias)), F.lit("other"))


def alias_table(events):
    """The aliases of the feed, as found in the data, and their categories."""
    found = events.filter(F.col("event_type").isNotNull()).select(F.col("event_type").alias("Stock_Alias")).distinct()
    return found.withColumn("Category", category_of("Stock_Alias"))


def bar_texts(events):
    return texts_of_bars(daily_bars(events))


def texts_of_bars(bars):
    """Daily bars as the text fields of the price feed: grouped digits, US dates without padding."""
    return bars.select(
        F.date_format("day", "M/d/yyyy").alias("Date"), F.col("ticker").alias("Stock_Alias"),
        *[F.format_number(c.lower(), 2).alias(c) for c in ("Open", "Close", "High", "Low")],
        F.format_number("volume", 0).alias("Volume"),
    )


@query("nest_entries_by_date", f"""
    WITH b AS (SELECT * FROM ({BARS_SQL}) WHERE {unit_hash_sql("absent", "day", "ticker")} < 0.6), d AS (SELECT DISTINCT day FROM b),
    k AS (SELECT ticker, {CATEGORY_SQL.format("ticker")} AS category FROM (SELECT DISTINCT event_type AS ticker FROM events WHERE event_type IS NOT NULL))
    SELECT strftime(d.day, '%-m/%-d/%Y') AS day, k.category, k.ticker AS alias, coalesce(format('{{:,}}', volume), 'n/a') AS volume
    FROM d CROSS JOIN k LEFT JOIN b ON b.day = d.day AND b.ticker = k.ticker""")
def nest_entries_by_date(t):
    """Some bars, chosen by a hash of their key, are absent, so that the grid has holes to fill."""
    bars = daily_bars(t.events).filter(unit_hash("absent", F.col("day"), F.col("ticker")) < 0.6)
    nested = loads.nest_by_date(texts_of_bars(bars), "Date", "Stock_Alias", ["Open", "Close", "High", "Low", "Volume"], alias_table(t.events))
    flat = entry_properties(explode_entries(nested), ["Volume"])
    return flat.select(F.col("Date").alias("day"), F.col("Category").alias("category"), F.col("Stock_Alias").alias("alias"), F.col("Volume").alias("volume"))


_HOLES = ", ".join(f"CASE WHEN {p} <= {limit} THEN {p} END AS {p}" for p, limit in zip(POLLUTANTS, (60, 60, 60, 60, 60)))


@query("null_row_cleaning_report", f"""
    WITH n AS (SELECT (pm10 IS NULL)::INTEGER + (pm2_5 IS NULL)::INTEGER + (nitrogen_dioxide IS NULL)::INTEGER
                 + (sulphur_dioxide IS NULL)::INTEGER + (ozone IS NULL)::INTEGER AS n FROM (SELECT {_HOLES} FROM ({HOURLY_SQL})))
    SELECT count(*) AS total_rows, count(*) FILTER (n = 5) AS all_null_rows, count(*) FILTER (n BETWEEN 1 AND 4) AS some_null_rows,
           count(*) FILTER (n = 0) AS remaining_rows FROM n""")
def null_row_cleaning_report(t):
    holes = hourly_measures(t.events).select([F.when(F.col(p) <= 60, F.col(p)).alias(p) for p in POLLUTANTS])
    return quality.clean_nulls(holes, {})[1]


@query("null_row_cleaning", f"""
    SELECT time_string FROM ({HOURLY_SQL}) WHERE pm10 <= 60 AND pm2_5 <= 60 AND nitrogen_dioxide <= 60 AND sulphur_dioxide <= 60 AND ozone <= 60""")
def null_row_cleaning(t):
    holes = hourly_measures(t.events).select(
        F.col("time_string").alias("time"), *[F.when(F.col(p) <= 60, F.col(p)).alias(p) for p in POLLUTANTS]
    )
    return quality.clean_nulls(holes, {"time": "time_string"})[0].select("time_string")
