"""Scalar expressions and SQL routines."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import scalars as S
from tidemill.operators.ordering import exact_percentiles
from tidemill.plans.registry import query
from tidemill.sources.tables import NATION_MONTH_SQL, day_text, monthly_nation_measures


@query("string_case", """
    SELECT c_custkey, upper(c_name) AS upper_name, lower(trim('  ' || c_name || ' ')) AS lower_name,
           upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS segment FROM customer""")
def string_case(t):
    return t.customer.select(
        "c_custkey",
        F.upper("c_name").alias("upper_name"),
        S.clean_text(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("lower_name"),
        F.initcap("c_mktsegment").alias("segment"),
    )


@query("clean_strings", """
    SELECT p_partkey, trim(replace(' "' || p_name || '" (' || p_type || ') ', '"', '')) AS cleaned FROM part""")
def clean_strings(t):
    quoted = F.concat(F.lit(' "'), F.col("p_name"), F.lit('" ('), F.col("p_type"), F.lit(") "))
    return t.part.select("p_partkey", S.clean_string(quoted).alias("cleaned"))


@query("mmss_format", """
    SELECT l_orderkey, l_linenumber, lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_quantity::INTEGER AS VARCHAR), 2, '0') AS length
    FROM lineitem""")
def mmss_format(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", S.mmss(F.col("l_linenumber"), F.col("l_quantity").cast("int")).alias("length"))


@query("suffix_class_counts", """
    SELECT CASE WHEN o_orderpriority LIKE '%HIGH' THEN 'high' WHEN o_orderpriority LIKE '%LOW' THEN 'low' ELSE 'single' END AS kind,
           count(*) AS n FROM orders GROUP BY 1""")
def suffix_class_counts(t):
    kind = S.suffix_class(F.col("o_orderpriority"), {"HIGH": "high", "LOW": "low"}, "single")
    return t.orders.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("word_count", """
    SELECT doc_id, (length(trim(text)) - length(replace(trim(text), ' ', '')) + 1)::INTEGER AS words FROM documents""")
def word_count(t):
    return t.documents.select("doc_id", S.word_count(F.col("text")).alias("words"))


@query("tenure_days", """
    SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), CASE WHEN o_orderstatus = 'F'
      THEN CAST(o_orderdate AS DATE) + 30 ELSE DATE '2002-01-01' END)::INTEGER AS days FROM orders""")
def tenure_days(t):
    start = F.col("o_orderdate").cast("date")
    end = F.when(F.col("o_orderstatus") == "F", F.date_add(start, 30))
    return t.orders.select("o_orderkey", S.tenure_days(start, end, "2002-01-01").alias("days"))


@query("century_label", """
    SELECT (substr(CAST(year(o_orderdate) AS VARCHAR), 1, 2)::INTEGER + 1) || 'th Century' AS century, count(*) AS n FROM orders GROUP BY 1
    UNION SELECT 'All', count(*) FROM orders""")
def century_label(t):
    counts = t.orders.groupBy(S.century_label(F.col("o_orderdate")).alias("century")).agg(F.count(F.lit(1)).alias("n"))
    return counts.union(counts.agg(F.sum("n")).select(F.lit("All"), "sum(n)")).distinct()


@query("century_label_exact", """
    SELECT ceil(year(o_orderdate) / 100)::INTEGER || CASE ceil(year(o_orderdate) / 100)::INTEGER WHEN 21 THEN 'st' ELSE 'th' END || ' Century' AS century,
           count(*) AS n FROM orders GROUP BY 1""")
def century_label_exact(t):
    return t.orders.groupBy(S.century_label(F.col("o_orderdate"), exact=True).alias("century")).agg(F.count(F.lit(1)).alias("n"))


@query("era_counts", """
    SELECT CASE WHEN year(o_orderdate) < 1900 THEN '19th century and earlier' WHEN year(o_orderdate) < 2000 THEN '20th century'
           ELSE '21th century' END AS era, count(o_orderkey) AS n FROM orders GROUP BY 1""")
def era_counts(t):
    return t.orders.groupBy(S.era_label(F.col("o_orderdate")).alias("era")).agg(F.count("o_orderkey").alias("n"))


@query("ordinal_date", """
    SELECT o_orderkey, strftime(o_orderdate, '%A ') || day(o_orderdate) || CASE day(o_orderdate) WHEN 1 THEN 'st' WHEN 2 THEN 'nd'
             WHEN 3 THEN 'rd' ELSE 'th' END || strftime(o_orderdate, ' %B %Y') AS full_date,
           strftime(o_orderdate, '%A ') || day(o_orderdate) || CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' WHEN day(o_orderdate) IN (2, 22)
             THEN 'nd' WHEN day(o_orderdate) IN (3, 23) THEN 'rd' ELSE 'th' END || strftime(o_orderdate, ' %B %Y') AS exact_date FROM orders""")
def ordinal_date(t):
    c = F.col("o_orderdate")
    return t.orders.select("o_orderkey", S.ordinal_date(c).alias("full_date"), S.ordinal_date(c, exact=True).alias("exact_date"))


@query("parse_mixed_dates", """
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""")
def parse_mixed_dates(t):
    c = F.col("o_orderdate")
    rendered = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(c, "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(c, "M/d/yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(c, "dd. MMM yyyy"))
        .otherwise(F.date_format(c, "M/dd/yyyy"))
    )
    return t.orders.select("o_orderkey", day_text(S.parse_us_date(rendered)).alias("day"))


@query("parse_grouped_numbers", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN NULL
             ELSE o_totalprice END AS price, floor(o_totalprice)::DOUBLE AS volume FROM orders""")
def parse_grouped_numbers(t):
    p, c = F.col("o_orderpriority"), F.col("o_totalprice")
    price = (
        F.when(p == "1-URGENT", "n/a").when(p == "2-HIGH", "")
        .when(p == "3-MEDIUM", F.concat(F.lit("-"), F.format_number(c, 2)))
        .when(p == "5-LOW", F.format_number(c, 4))
        .otherwise(F.format_number(c, 2))
    )
    volume = F.format_number(F.floor(c), 0)
    return t.orders.select(
        "o_orderkey", S.parse_price(price).cast("double").alias("price"), S.parse_volume(volume).cast("double").alias("volume")
    )


@query("safe_ratio", f"""
    SELECT country, CAST(month AS VARCHAR) AS month, round(deaths / nullif(recoveries, 0), 6) AS ratio FROM ({NATION_MONTH_SQL})""")
def safe_ratio(t):
    m = monthly_nation_measures(t.orders, t.customer, t.nation)
    return m.select("country", day_text("month").alias("month"), F.round(S.safe_ratio(F.col("deaths"), F.col("recoveries")), 6).alias("ratio"))


def quantile_class(df, column, probs, labels):
    """Class by the exact quantiles of the column; each class includes its upper cut."""
    cuts = exact_percentiles(df, [], column, probs, "_cuts")
    bounds = [F.col("_cuts")[i] for i in range(len(probs))]
    return df.join(F.broadcast(cuts)).withColumn("class", S.upper_bound_class(F.col(column), bounds, labels)).drop("_cuts")


@query("quintile_class", """
    WITH q AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS c FROM customer)
    SELECT c_custkey, CASE WHEN c_acctbal <= c[1] THEN 'low' WHEN c_acctbal <= c[2] THEN 'low middle' WHEN c_acctbal <= c[3] THEN 'middle'
      WHEN c_acctbal <= c[4] THEN 'upper middle' ELSE 'upper' END AS class FROM customer, q""")
def quintile_class(t):
    labels = ["low", "low middle", "middle", "upper middle", "upper"]
    return quantile_class(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", [0.2, 0.4, 0.6, 0.8], labels).select("c_custkey", "class")


@query("relabel_category", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS status,
           strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def relabel_category(t):
    status = F.when(F.col("o_orderstatus") == "F", "Finished").when(F.col("o_orderstatus") == "O", "Open").otherwise("Pending")
    return t.orders.select("o_orderkey", status.alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("combine_date_hour", "SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS time FROM events")
def combine_date_hour(t):
    parts = t.events.select("event_id", day_text("ts").alias("day"), F.date_format("ts", "HH:mm").alias("hour"))
    time = F.to_timestamp_ntz(F.concat_ws(" ", "day", "hour"), F.lit("yyyy-MM-dd HH:mm"))
    return parts.select("event_id", F.date_format(time, "yyyy-MM-dd HH:mm:ss").alias("time"))


@query("pad_time_parts", """
    SELECT event_id, strftime(ts, '%m/%d/%Y') AS day, strftime(ts, '%H:%M') AS hour FROM events""")
def pad_time_parts(t):
    us = F.split(F.date_format("ts", "M/d/yyyy"), "/")
    clock = F.split(F.date_format("ts", "H:m"), ":")
    return t.events.select(
        "event_id",
        F.concat_ws("/", S.pad2(us[0]), S.pad2(us[1]), us[2]).alias("day"),
        F.concat_ws(":", S.pad2(clock[0]), S.pad2(clock[1])).alias("hour"),
    )


@query("sql_functions", """
    SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01')::INTEGER AS days,
      trim(replace('"' || o_orderpriority || '" ', '"', '')) AS cleaned,
      lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || ':' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') AS length,
      CASE WHEN ends_with(o_orderpriority, 'HIGH') THEN 'HIGH' WHEN ends_with(o_orderpriority, 'LOW') THEN 'LOW' ELSE 'other' END AS kind,
      (substr(CAST(year(o_orderdate) AS VARCHAR), 1, 2)::INTEGER + 1) || 'th Century' AS century,
      (length(o_orderpriority) - length(replace(o_orderpriority, ' ', '')) + 1)::INTEGER AS words,
      (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n_lines,
      (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS n_returned FROM orders""")
def sql_functions(t):
    """Eight SQL functions; the last two count in another table, and Catalyst turns them into joins."""
    S.register_sql_functions(t.spark, {"order_lines": t.lineitem.select("l_orderkey", "l_returnflag")})
    found = t.spark.sql(
        """SELECT o_orderkey, tenure_days(CAST(o_orderdate AS DATE), NULL, DATE '2002-01-01') AS days,
             clean_string(concat('"', o_orderpriority, '" ')) AS cleaned, mmss(month(o_orderdate), day(o_orderdate)) AS length,
             suffix_class(o_orderpriority, 'HIGH', 'LOW') AS kind, century_label(CAST(o_orderdate AS DATE)) AS century,
             word_count(o_orderpriority) AS words, line_count(o_orderkey) AS n_lines, flagged_count(o_orderkey, 'R') AS n_returned FROM {orders}""",
        orders=t.orders,
    )
    S.drop_sql_functions(t.spark, ["order_lines"])
    return found


@query("table_function", """
    SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE year(o_orderdate) = 1998 AND n_name LIKE '%ION_1%'""")
def table_function(t):
    for name in ("orders", "customer", "nation"):
        getattr(t, name).createOrReplaceTempView(f"fn_{name}")
    t.spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION chosen_orders(wanted_year INT, nation_part STRING)
        RETURNS TABLE (o_orderkey BIGINT, c_name STRING, n_name STRING) RETURN
        SELECT o_orderkey, c_name, n_name FROM fn_orders JOIN fn_customer ON o_custkey = c_custkey
        JOIN fn_nation ON c_nationkey = n_nationkey
        WHERE year(o_orderdate) = wanted_year AND contains(n_name, nation_part)""")
    found = t.spark.sql("SELECT * FROM chosen_orders(1998, 'ION_1')")
    t.spark.sql("DROP TEMPORARY FUNCTION chosen_orders")
    for name in ("orders", "customer", "nation"):
        t.spark.catalog.dropTempView(f"fn_{name}")
    return found
