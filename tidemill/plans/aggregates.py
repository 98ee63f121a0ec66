"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import quality, summaries
from tidemill.plans.registry import query
from tidemill.session import stage
from tidemill.sources.tables import day_text


@query("agg_global", """
    SELECT count(c_custkey) AS n_rows, count(nullif(c_mktsegment, 'BUILDING')) AS n_segment, round(sum(c_acctbal), 2) AS total,
           round(avg(c_acctbal), 6) AS mean, CAST(trunc(avg(c_nationkey)) AS INTEGER) AS int_mean FROM customer""")
def agg_global(t):
    return t.customer.agg(
        F.count("c_custkey").alias("n_rows"),
        F.count(F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("n_segment"),
        F.round(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double"), 2).alias("total"),
        F.round(F.avg("c_acctbal"), 6).alias("mean"),
        F.avg("c_nationkey").cast("int").alias("int_mean"),
    )


@query("agg_group_keys", """
    SELECT o_orderstatus, substr(o_orderpriority, 1, 1) AS level, year(o_orderdate)::INTEGER AS year, count(*) AS n,
           round(avg(o_totalprice), 4) AS mean_price FROM orders GROUP BY 1, 2, 3""")
def agg_group_keys(t):
    return t.orders.groupBy(
        "o_orderstatus", F.substring("o_orderpriority", 1, 1).alias("level"), F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price"))


@query("agg_having", """
    SELECT c_name, o_orderstatus, count(*) AS n_orders FROM customer JOIN orders ON c_custkey = o_custkey
    GROUP BY 1, 2 HAVING count(*) > 5""")
def agg_having(t):
    counts = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
    return (
        counts.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_name", "o_orderstatus")
        .agg(F.sum("n_orders").alias("n_orders"))
        .filter("n_orders > 5")
    )


@query("distinct_values", """
    SELECT o_orderstatus, o_orderpriority, n_customers FROM
      (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)
      JOIN (SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1) USING (o_orderstatus)""")
def distinct_values(t):
    pairs = t.orders.select("o_orderstatus", "o_orderpriority").distinct()
    return pairs.join(t.orders.groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("n_customers")), "o_orderstatus")


LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_linestatus"


@query("dedup_rows", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem")
def dedup_rows(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag").dropDuplicates()


@query("dedup_on_keys", f"""
    SELECT {LINE_COLUMNS} FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) = 1""")
def dedup_on_keys(t):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    kept = summaries.dedup_on_keys(t.lineitem, ["l_orderkey", "l_linenumber"], [F.col(c) for c in order])
    return kept.select(*LINE_COLUMNS.split(", "))


@query("date_bounds", """
    SELECT CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_day, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day FROM orders""")
def date_bounds(t):
    return t.orders.agg(day_text(F.min("o_orderdate")).alias("first_day"), day_text(F.max("o_orderdate")).alias("last_day"))


@query("nonnull_count_by_key", """
    SELECT event_type, count(*) AS n FROM events WHERE nullif(event_type || (value > 50), 'errortrue') IS NOT NULL GROUP BY 1""")
def nonnull_count_by_key(t):
    measured = t.events.withColumn("value", F.when((F.col("event_type") == "error") & (F.col("value") > 50), None).otherwise(F.col("value")))
    return measured.filter(F.col("value").isNotNull()).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def pivot_counts(counts, row, column, n):
    """Matrix of the summed counts, a column for each value found, zero where a pair does not occur."""
    return counts.groupBy(row).pivot(column).agg(F.sum(n)).na.fill(0)


@query("pivot_matrix", """
    WITH f AS (SELECT c_mktsegment, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey)
    SELECT s.c_mktsegment, p.o_orderpriority, count(f.o_orderpriority) AS n
    FROM (SELECT DISTINCT c_mktsegment FROM f) s CROSS JOIN (SELECT DISTINCT o_orderpriority FROM f) p
    LEFT JOIN f ON f.c_mktsegment IS NOT DISTINCT FROM s.c_mktsegment AND f.o_orderpriority = p.o_orderpriority GROUP BY 1, 2""")
def pivot_matrix(t):
    """The matrix has a column for each priority of the data; it is shown in long form."""
    counts = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    per_pair = counts.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "o_orderpriority").agg(F.sum("n").alias("n"))
    matrix = pivot_counts(stage(per_pair, "pair_counts"), "c_mktsegment", "o_orderpriority", "n")
    return matrix.unpivot(["c_mktsegment"], matrix.columns[1:], "o_orderpriority", "n")


@query("sum_by_two_keys", """
    SELECT n_name, c_mktsegment, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def sum_by_two_keys(t):
    per_key = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("part"))
    return (
        per_key.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "c_mktsegment").agg(F.sum("part").cast("double").alias("total"))
    )


@query("mean_over_runs", """
    SELECT day(ts)::INTEGER AS epoch, round(avg(value), 6) AS mean_value, round(avg(json_extract(props, '$.k')::INTEGER), 6) AS mean_k
    FROM events GROUP BY 1""")
def mean_over_runs(t):
    return mean_by_epoch(t.events.select(
        F.dayofmonth("ts").alias("epoch"), F.col("value").alias("mean_value"),
        F.get_json_object("props", "$.k").cast("int").alias("mean_k"),
    ), "epoch")


def mean_by_epoch(runs, epoch):
    return runs.groupBy(epoch).agg(*[F.round(F.avg(c), 6).alias(c) for c in runs.columns if c != epoch])


@query("null_profile", """
    SELECT column_name, null_count, null_count > 0 AS has_null FROM (
      SELECT count(*) FILTER (event_id IS NULL) AS event_id, count(*) FILTER (value > 100) AS value,
             count(*) FILTER (event_type = 'view') AS event_type FROM events)
    UNPIVOT (null_count FOR column_name IN (event_id, value, event_type))""")
def null_profile(t):
    holes = t.events.select(
        "event_id",
        F.when(F.col("value") <= 100, F.col("value")).alias("value"),
        F.nullif("event_type", F.lit("view")).alias("event_type"),
    )
    return quality.null_counts(holes, holes.columns).withColumn("has_null", F.col("null_count") > 0)


@query("describe_profile", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
      round(min({c})::DOUBLE, 4) AS min, round(quantile_cont({c}::DOUBLE, 0.25), 4) AS q25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS q50,
      round(quantile_cont({c}::DOUBLE, 0.75), 4) AS q75, round(max({c})::DOUBLE, 4) AS max FROM customer""" for c in ("c_acctbal", "c_nationkey")))
def describe_profile(t):
    profile = summaries.describe_profile(t.customer, ["c_acctbal", "c_nationkey"])
    return profile.select("column_name", "n", *[F.round(c, 4).alias(c) for c in profile.columns[2:]])


@query("class_share", """
    SELECT quality, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels), 6) AS share FROM labels GROUP BY 1""")
def class_share(t):
    return summaries.class_share(t.labels, "quality").withColumn("share", F.round("share", 6))


@query("max_word_count", "SELECT max(len(regexp_split_to_array(trim(text), '[ \\t\\n\\r\\f]+')))::INTEGER AS longest FROM documents")
def max_word_count(t):
    return t.documents.agg(F.max(F.size(F.split(F.trim("text"), "[ \\t\\n\\r\\f]+"))).alias("longest"))


@query("histogram_bins", """
    WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer),
    c AS (SELECT least(floor((c_acctbal - lo) / ((hi - lo) / 20)), 19)::INTEGER AS bin, count(*) AS n FROM customer, b GROUP BY 1)
    SELECT g.bin::INTEGER AS bin, round(lo + g.bin * ((hi - lo) / 20), 4) AS low, round(lo + (g.bin + 1) * ((hi - lo) / 20), 4) AS high,
           coalesce(n, 0) AS n FROM b, range(0, 20) g(bin) LEFT JOIN c ON c.bin = g.bin""")
def histogram_bins(t):
    bins = summaries.histogram(t.customer, "c_acctbal", 20)
    return bins.select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


@query("boxplot_summary", """
    WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
               FROM events GROUP BY 1)
    SELECT event_type, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
      min(value) FILTER (value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_low,
      max(value) FILTER (value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS whisker_high,
      count(*) FILTER (value NOT BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5) AS n_outliers
    FROM events JOIN q USING (event_type) GROUP BY event_type, q.q1, q.median, q.q3""")
def boxplot_summary(t):
    boxes = summaries.box_summary(t.events.select("event_type", "value"), "event_type", "value")
    return boxes.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("initial_stats", """
    SELECT upper(substr(p_name, 1, 1)) AS initial, count(*) AS n, round(avg(length(rtrim(p_name))), 6) AS mean_length FROM part GROUP BY 1""")
def initial_stats(t):
    return t.part.groupBy(F.upper(F.substring("p_name", 1, 1)).alias("initial")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(F.length(F.rtrim("p_name"))), 6).alias("mean_length")
    )
