"""Projections, filters, row edits and data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import scalars as S
from tidemill.operators import edits, quality
from tidemill.operators.joins import bounded
from tidemill.plans.registry import query
from tidemill.sources.tables import (
    BARS_SQL, HOURLY_SQL, POLLUTANTS, daily_bars, day_text, hourly_measures,
)


@query("project_alias", "SELECT c_custkey AS customer_id, c_name AS name, c_acctbal AS balance FROM customer")
def project_alias(t):
    return t.customer.alias("c").select(
        F.col("c.c_custkey").alias("customer_id"), F.col("c.c_name").alias("name"), F.col("c.c_acctbal").alias("balance")
    )


def stage_customers(customer):
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        S.clean_text(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("first_name"),
        S.clean_text(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("last_name"),
        S.clean_text(F.col("c_mktsegment")).alias("segment"),
    )


def stage_orders(orders):
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_timestamp"),
        F.lower("o_orderstatus").alias("status"),
        S.money(F.col("o_totalprice")).alias("total_amount"),
    )


def stage_payments(lineitem):
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_id"),
        F.lower("l_returnflag").alias("payment_method"),
        S.money(F.col("l_extendedprice")).alias("amount"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("paid_at"),
    )


@query("stg_customers", """
    SELECT c_custkey AS customer_id, lower(trim(split_part(c_name, '#', 1))) AS first_name,
           lower(trim(split_part(c_name, '#', 2))) AS last_name, lower(trim(c_mktsegment)) AS segment FROM customer""")
def stg_customers(t):
    return stage_customers(t.customer)


@query("stg_orders", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_timestamp,
           lower(o_orderstatus) AS status, CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS total_amount FROM orders""")
def stg_orders(t):
    staged = stage_orders(t.orders)
    return staged.withColumns({
        "order_timestamp": F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss"),
        "total_amount": F.col("total_amount").cast("double"),
    })


@query("stg_payments", """
    SELECT l_orderkey AS order_id, l_linenumber AS payment_id, lower(l_returnflag) AS payment_method,
           CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS amount,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS paid_at FROM lineitem""")
def stg_payments(t):
    staged = stage_payments(t.lineitem)
    return staged.withColumns({
        "paid_at": F.date_format("paid_at", "yyyy-MM-dd HH:mm:ss"), "amount": F.col("amount").cast("double"),
    })


@query("split_timestamp_string", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H:%M') AS hour FROM events""")
def split_timestamp_string(t):
    text = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time_string"))
    day, hour = split_iso(F.col("time_string"))
    return text.select("event_id", day_text(day).alias("day"), hour.alias("hour"))


def split_iso(c):
    """Date and hour text of an ISO timestamp string; a malformed date becomes null."""
    return F.try_to_date(F.split_part(c, F.lit("T"), F.lit(1))), F.split_part(c, F.lit("T"), F.lit(2))


def typed_measures(raw):
    """All-text hourly staging rows to date, hour and numeric measures."""
    day, hour = split_iso(F.col("time_string"))
    return raw.select(day.alias("day"), hour.alias("hour"), *[F.col(p).try_cast("double").alias(p) for p in POLLUTANTS])


@query("stg_hourly_measures", f"""
    SELECT substr(time_string, 1, 10) AS day, substr(time_string, 12, 5) AS hour,
           {", ".join(f"round({p}, 8) AS {p}" for p in POLLUTANTS)} FROM ({HOURLY_SQL})""")
def stg_hourly_measures(t):
    raw = hourly_measures(t.events)
    as_text = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    return typed_measures(as_text).withColumns({"day": day_text("day"), **{p: F.round(p, 8) for p in POLLUTANTS}})


@query("filter_in_list", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 1000 AND c_nationkey <> 3""")
def filter_in_list(t):
    c = t.customer
    wanted = c.c_mktsegment.isin("BUILDING", "MACHINERY") & (c.c_acctbal > 1000) & (c.c_nationkey != 3)
    return c.filter(wanted).select("c_custkey", "c_name", "c_mktsegment")


@query("like_wildcards", """
    SELECT 'suffix' AS pattern, p_partkey AS id FROM part WHERE p_name ILIKE '%RING'
    UNION ALL SELECT 'infix', p_partkey FROM part WHERE p_type ILIKE '%and%'
    UNION ALL SELECT 'month', o_orderkey FROM orders WHERE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) LIKE '____-10%'""")
def like_wildcards(t):
    part = t.part
    suffix = part.filter(F.col("p_name").ilike("%RING")).select(F.lit("suffix").alias("pattern"), F.col("p_partkey").alias("id"))
    infix = part.filter(F.col("p_type").ilike("%and%")).select(F.lit("infix"), "p_partkey")
    october = t.orders.filter(F.col("o_orderdate").cast("date").cast("string").like("____-10%"))
    return suffix.unionAll(infix).unionAll(october.select(F.lit("month"), "o_orderkey"))


@query("char_class_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^[A-Ma-m]')")
def char_class_filter(t):
    return t.part.filter(F.col("p_name").rlike("(?i)^[A-M]")).select("p_partkey", "p_name")


def nations_matching(supplier, nation, region, name_part=""):
    """Distinct supplier nations in regions whose name contains ``name_part``; the empty default keeps all."""
    wanted = region.filter(F.contains(F.upper("r_name"), F.upper(F.lit(name_part))))
    return (
        nation.join(bounded(wanted), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(supplier.select("s_nationkey"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
        .select("n_name")
        .distinct()
    )


@query("param_substring_distinct", """
    SELECT DISTINCT 'america' AS name_part, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name ILIKE '%america%'
    UNION ALL SELECT DISTINCT '', n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name ILIKE '%' || '' || '%'""")
def param_substring_distinct(t):
    parts = [
        nations_matching(t.supplier, t.nation, t.region, p).select(F.lit(p).alias("name_part"), "n_name")
        for p in ("america", "")
    ]
    return parts[0].unionAll(parts[1])


@query("dashboard_slice", f"""
    SELECT ticker, strftime(day, '%B %d, %Y') AS day_label, round(open, 4) AS open, round(close, 4) AS close, volume
    FROM ({BARS_SQL}) WHERE ticker IN ('click', 'view') AND day BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def dashboard_slice(t):
    wanted = t.events.filter(
        F.col("event_type").isin("click", "view")
        & (F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
        & (F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))
    )
    return (
        daily_bars(wanted)
        .sort("day")
        .select("ticker", F.date_format("day", "MMMM dd, yyyy").alias("day_label"),
                F.round("open", 4).alias("open"), F.round("close", 4).alias("close"), "volume")
    )


@query("mask_rows_report", """
    WITH r AS (SELECT count(*) AS total_rows,
        count(*) FILTER (c_mktsegment <> 'FURNITURE' AND c_acctbal >= 0) AS kept_rows FROM customer)
    SELECT total_rows, kept_rows, total_rows - kept_rows AS dropped_rows FROM r""")
def mask_rows_report(t):
    people = t.customer.withColumn("profession", F.nullif("c_mktsegment", F.lit("FURNITURE")))
    return quality.mask_rows(people, ["profession"], F.col("c_acctbal") >= 0)[1]


@query("mask_rows_kept", """
    SELECT c_custkey, c_mktsegment AS profession, c_acctbal FROM customer
    WHERE c_mktsegment <> 'FURNITURE' AND c_acctbal >= 0""")
def mask_rows_kept(t):
    people = t.customer.withColumn("profession", F.nullif("c_mktsegment", F.lit("FURNITURE")))
    kept, _ = quality.mask_rows(people, ["profession"], F.col("c_acctbal") >= 0)
    return kept.select("c_custkey", "profession", "c_acctbal")


def within_period(df, day_col, start, extra_days):
    """Rows from the start day through ``extra_days`` later."""
    begin = F.lit(start).cast("date")
    return df.filter((F.col(day_col).cast("date") >= begin) & (F.col(day_col).cast("date") <= F.date_add(begin, extra_days)))


@query("period_filter", """
    SELECT p.label AS period, count(*) AS n_rows, round(avg(value), 4) AS mean_value
    FROM events JOIN (VALUES ('today', 0), ('tomorrow', 1), ('day after', 2)) p(label, n)
      ON CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-10' + p.n::INTEGER GROUP BY 1""")
def period_filter(t):
    start = "2024-01-10"
    periods = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(n).alias("n"))
        for label, n in (("today", 0), ("tomorrow", 1), ("day after", 2))
    ])
    day_no = F.date_diff(F.col("ts").cast("date"), F.lit(start).cast("date"))
    covering = F.transform(F.filter(periods, lambda p: day_no <= p["n"]), lambda p: p["label"])
    tagged = within_period(t.events, "ts", start, 2).withColumn("period", F.explode(covering))
    return tagged.groupBy("period").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("value"), 4).alias("mean_value"))


@query("update_rules", """
    WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS s,
                      o_orderpriority AS p FROM orders),
         b AS (SELECT o_orderkey, CASE WHEN s = 'pending' AND p = '1-URGENT' THEN 'rush' ELSE s END AS s, p FROM a)
    SELECT o_orderkey, CASE WHEN s = 'rush' OR s = 'F' THEN 'closed' ELSE s END AS o_orderstatus,
           CASE WHEN o_orderkey = 1 THEN 'fixed' ELSE p END AS o_orderpriority FROM b""")
def update_rules(t):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return edits.update_where(orders, [
        (status == "P", {"o_orderstatus": F.lit("pending")}),
        ((status == "pending") & (priority == "1-URGENT"), {"o_orderstatus": F.lit("rush")}),
        ((status == "rush") | (status == "F"), {"o_orderstatus": F.lit("closed")}),
        (F.col("o_orderkey") == 1, {"o_orderpriority": F.lit("fixed")}),
    ])


@query("delete_by_predicate", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE NOT coalesce(nullif(o_orderstatus, 'O') = 'F' AND o_totalprice > 100000, false)""")
def delete_by_predicate(t):
    gone = (F.nullif("o_orderstatus", F.lit("O")) == "F") & (F.col("o_totalprice") > 100000)
    return edits.delete_where(t.orders, gone).select("o_orderkey", "o_totalprice")


@query("insert_partial_defaults", """
    SELECT r_regionkey, r_name, 'open' AS status FROM region
    UNION ALL SELECT r_regionkey + 100, NULL, 'new' FROM region
    UNION ALL SELECT r_regionkey + 200, lower(r_name), 'new' FROM region""")
def insert_partial_defaults(t):
    region = t.region.withColumn("status", F.lit("open"))
    only_key = t.region.select((F.col("r_regionkey") + 100).alias("r_regionkey"))
    key_and_name = t.region.select(
        (F.col("r_regionkey") + 200).alias("r_regionkey"), F.lower("r_name").alias("r_name")
    )
    first = edits.insert_rows(region, only_key, {"status": F.lit("new")})
    return edits.insert_rows(first, key_and_name, {"status": F.lit("new")})


@query("identity_column", """
    SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders""")
def identity_column(t):
    return edits.with_identity(t.orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], "id").select("id", "o_orderkey")


@query("add_drop_column", """
    SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice * 0.9, 4) AS sale_price FROM part""")
def add_drop_column(t):
    return t.part.withColumn("sale_price", F.round(F.col("p_retailprice") * 0.9, 4)).drop("p_retailprice")


@query("ref_set_null", """
    SELECT c_custkey, CASE WHEN n_regionkey = 2 THEN NULL ELSE n_name END AS nation_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def ref_set_null(t):
    gone = t.nation.filter("n_regionkey = 2").select("n_nationkey")
    edited = edits.set_null_reference(t.customer.select("c_custkey", "c_nationkey"), gone, "c_nationkey")
    kept = t.nation.join(gone, "n_nationkey", "left_anti")
    return edited.join(kept, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", F.col("n_name").alias("nation_name")
    )


@query("ref_cascade_delete", """
    SELECT l_returnflag, count(*) AS n_lines, sum(l_linenumber)::BIGINT AS line_sum FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY 1""")
def ref_cascade_delete(t):
    gone = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey")
    kept = edits.cascade_delete(t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag"), gone, "l_orderkey")
    return kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_linenumber").alias("line_sum"))


@query("insert_audit_log", """
    SELECT 'added new event' AS message, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1
    UNION ALL SELECT 'user ' || user_id, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1
    UNION ALL SELECT CASE event_type WHEN 'error' THEN 'added failure' WHEN 'purchase' THEN 'added sale'
                     ELSE 'added activity' END, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1""")
def insert_audit_log(t):
    inserted = t.events.filter(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    kind = (
        F.when(F.col("event_type") == "error", "added failure")
        .when(F.col("event_type") == "purchase", "added sale")
        .otherwise("added activity")
    )
    messages = F.array(F.lit("added new event"), F.concat(F.lit("user "), F.col("user_id").cast("string")), kind)
    return edits.audit_rows(inserted, F.explode(messages)).groupBy("message").agg(F.count(F.lit(1)).alias("n"))


@query("dq_not_null", """
    SELECT column_name, null_count FROM (
      SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey, count(*) FILTER (o_custkey IS NULL) AS o_custkey,
             count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL) AS o_orderstatus FROM orders)
    UNPIVOT (null_count FOR column_name IN (o_orderkey, o_custkey, o_orderstatus))""")
def dq_not_null(t):
    orders = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    return quality.null_counts(orders, ["o_orderkey", "o_custkey", "o_orderstatus"])


@query("dq_unique", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(t):
    return quality.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_foreign_key", """
    SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS
      (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P')""")
def dq_foreign_key(t):
    parents = t.orders.filter("o_orderstatus <> 'P'")
    return quality.orphans(t.lineitem, parents, "l_orderkey", "o_orderkey").select("l_orderkey", "l_linenumber")


def order_texts(orders):
    """Orders as text records, some of them malformed by rules on their own values."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        F.col("o_orderkey"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("country"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), date)).otherwise(date).alias("date"),
        F.when(F.col("o_totalprice") > 400000, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("cases"),
    )


@query("sanity_flag", """
    SELECT upper(nullif(o_orderpriority, '5-LOW')) AS country, count(*) AS n_rows,
           count(*) FILTER (o_orderpriority = '5-LOW' OR o_orderstatus = 'P' OR o_totalprice > 400000) AS n_failed,
           count(*) FILTER (o_orderstatus = 'P') AS n_bad_date
    FROM orders GROUP BY 1""")
def sanity_flag(t):
    parsed = order_texts(t.orders).select(
        F.upper("country").alias("country"),
        F.col("date").alias("date_text"),
        F.try_to_date("date", "yyyy-MM-dd").alias("date"),
        F.col("cases").try_cast("int").alias("cases"),
    )
    checks = [
        F.col("country").isNotNull(),
        F.col("date_text").rlike(r"^\d{4}-\d{2}-\d{2}$"),
        F.col("date").isNotNull(),
        F.col("cases").isNotNull(),
    ]
    return quality.add_sanity_flag(parsed, checks).groupBy("country").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("sanity_check")).alias("n_failed"),
        F.count_if(F.col("date").isNull()).alias("n_bad_date"),
    )
