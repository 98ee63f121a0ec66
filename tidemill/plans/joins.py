"""Joins and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import joins as J
from tidemill.plans.registry import query
from tidemill.sources.marts import publish
from tidemill.plans.rows import stage_orders, stage_payments
from tidemill.session import stage
from tidemill.sources.tables import NATION_MONTH_SQL, day_text, monthly_nation_measures


@query("join_inner", "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def join_inner(t):
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "n_name")


@query("join_left", """
    SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders
    ON c_custkey = o_custkey""")
def join_left(t):
    orders = t.orders.select("o_custkey", "o_orderkey")
    return t.customer.select("c_custkey").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "o_orderkey"
    )


@query("join_right", """
    SELECT o_orderkey, l_partkey, l_quantity FROM lineitem RIGHT JOIN orders
    ON l_orderkey = o_orderkey""")
def join_right(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    orders = t.orders.select("o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "right").select("o_orderkey", "l_partkey", "l_quantity")


@query("join_cross", "SELECT r_name, n_name FROM region, nation")
def join_cross(t):
    return J.product_of_dimensions(t.region.select("r_name"), t.nation.select("n_name"))


def join_measures(frames, keys):
    """Inner join of several measure tables on the same composite key."""
    first, *rest = frames
    for other in rest:
        first = first.join(other, keys)
    return first


@query("join_composite_three", f"SELECT country, CAST(month AS VARCHAR) AS month, cases, deaths, recoveries FROM ({NATION_MONTH_SQL})")
def join_composite_three(t):
    base = stage(monthly_nation_measures(t.orders, t.customer, t.nation), "measures")
    parts = [base.select("country", "month", m) for m in ("cases", "deaths", "recoveries")]
    return join_measures(parts, ["country", "month"]).withColumn("month", day_text("month"))


@query("join_star_counts", """
    SELECT r_name, n_name, count(*) AS n_customers FROM region JOIN nation ON r_regionkey = n_regionkey
    JOIN customer ON n_nationkey = c_nationkey WHERE r_name <> 'EUROPE' GROUP BY 1, 2 HAVING count(*) > 5""")
def join_star_counts(t):
    per_nation = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"))
    places = t.nation.join(t.region.filter("r_name <> 'EUROPE'"), F.col("n_regionkey") == F.col("r_regionkey"))
    counted = per_nation.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return counted.groupBy("r_name", "n_name").agg(F.sum("n_customers").alias("n_customers")).filter("n_customers > 5")


@query("join_bridge", """
    SELECT year(o_orderdate)::INTEGER AS year, p_name, count(*) AS n_lines FROM orders
    JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey
    WHERE p_size < 25 GROUP BY 1, 2 HAVING count(*) > 1""")
def join_bridge(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey")
    parts = t.part.filter("p_size < 25").select("p_partkey", "p_name")
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"))
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("year", "p_name")
        .agg(F.count(F.lit(1)).alias("n_lines"))
        .filter("n_lines > 1")
    )


def order_payments(orders, payments):
    """Payments summed per order, then left-joined: paid, outstanding, and whether nothing is left to pay."""
    paid = payments.groupBy("order_id").agg(
        F.sum("amount").alias("total_paid"), F.count(F.lit(1)).alias("payment_count")
    )
    zero = F.lit(0).cast("decimal(20,2)")
    joined = orders.join(paid, "order_id", "left").withColumns({
        "total_paid": F.coalesce("total_paid", zero),
        "payment_count": F.coalesce("payment_count", F.lit(0).cast("long")),
    })
    outstanding = joined.withColumn("outstanding_amount", F.col("total_amount") - F.col("total_paid"))
    return outstanding.withColumn(
        "is_fully_paid", F.coalesce((F.col("outstanding_amount") == 0) & (F.col("total_amount") > 0), F.lit(False))
    )


@query("order_payments_mart", """
    WITH p AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(10,2))) AS total_paid, count(*) AS n FROM lineitem GROUP BY 1),
    i AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_timestamp,
       lower(o_orderstatus) AS status, CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
       coalesce(total_paid, 0) AS total_paid, coalesce(n, 0) AS payment_count FROM orders LEFT JOIN p ON o_orderkey = l_orderkey)
    SELECT order_id, customer_id, order_timestamp, status, total_amount::DOUBLE AS total_amount, total_paid::DOUBLE AS total_paid,
       payment_count, (total_amount - total_paid)::DOUBLE AS outstanding_amount,
       (total_amount - total_paid = 0 AND total_amount > 0) AS is_fully_paid FROM i""")
def order_payments_mart(t):
    """Staging layers are views, the mart is a table: written whole, published, and read from the catalogue."""
    spark = t.spark
    stage_orders(t.orders).createOrReplaceTempView("stg_orders")
    stage_payments(t.lineitem).createOrReplaceTempView("stg_payments")
    mart = publish(order_payments(spark.table("stg_orders"), spark.table("stg_payments")), "order_payments")
    for view in ("stg_orders", "stg_payments"):
        spark.catalog.dropTempView(view)
    mart = mart.withColumn("order_timestamp", F.date_format("order_timestamp", "yyyy-MM-dd HH:mm:ss"))
    return mart.withColumns({c: F.col(c).cast("double") for c in ("total_amount", "total_paid", "outstanding_amount")})


@query("agg_then_dims", """
    SELECT c_name, n_name, n_orders, round(avg_price, 6) AS avg_price FROM
      (SELECT o_custkey, count(*) AS n_orders, avg(o_totalprice) AS avg_price FROM orders GROUP BY 1)
      JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def agg_then_dims(t):
    per_customer = J.pre_aggregated(t.orders, "o_custkey", n_orders=F.count(F.lit(1)), avg_price=F.avg("o_totalprice"))
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_name", "n_name", "n_orders", F.round("avg_price", 6).alias("avg_price"))
    )


@query("semi_join_in", """
    SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def semi_join_in(t):
    big = t.orders.filter("o_totalprice > 450000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("semi_join_distinct", """
    SELECT DISTINCT c_custkey, c_name FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 450000""")
def semi_join_distinct(t):
    big = t.orders.filter("o_totalprice > 450000").select("o_custkey")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "c_name").distinct()


@query("scalar_subquery", """
    SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey =
      (SELECT n_nationkey FROM nation WHERE n_regionkey = 3 ORDER BY n_nationkey LIMIT 1)""")
def scalar_subquery(t):
    one = t.nation.filter("n_regionkey = 3").orderBy("n_nationkey").limit(1).select("n_nationkey")
    return t.supplier.filter(F.col("s_nationkey") == one.scalar()).select("s_suppkey", "s_name")


@query("correlated_counts", """
    SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A') AS n_returned,
           (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey AND l_linestatus = 'O') AS n_open FROM orders""")
def correlated_counts(t):
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus")
    return J.with_child_counts(t.orders.select("o_orderkey"), "o_orderkey", lines, "l_orderkey", {
        "n_returned": F.col("l_returnflag") == "A",
        "n_open": F.col("l_linestatus") == "O",
    })


@query("top3_cross_counts", """
    WITH f AS (SELECT n_nationkey, n_name, p_brand FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
               JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey),
    tn AS (SELECT n_name FROM f GROUP BY 1 ORDER BY count(*) DESC, n_name LIMIT 3),
    tb AS (SELECT p_brand FROM f GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 3)
    SELECT n_name, p_brand, count(*) AS n_lines FROM tn CROSS JOIN tb JOIN f USING (n_name, p_brand) GROUP BY 1, 2""")
def top3_cross_counts(t):
    facts = (
        t.lineitem.select("l_suppkey", "l_partkey")
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("n_name", "p_brand")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    return top_pairs(stage(facts, "pair_counts"), "n_name", "p_brand", "n_lines", 3)


def top_pairs(counts, left, right, n, k):
    """Counts of the pairs formed by the ``k`` most frequent values on either side."""

    def top(c):
        return counts.groupBy(c).agg(F.sum(n).alias("_n")).orderBy(F.desc("_n"), c).limit(k).select(c)

    return counts.join(F.broadcast(top(left)), left, "left_semi").join(F.broadcast(top(right)), right, "left_semi")


@query("shared_category_countries", """
    WITH c AS (SELECT n_name, o_orderpriority || '/' || o_orderstatus AS category, o_totalprice FROM orders
               JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
    SELECT DISTINCT n_name FROM c WHERE n_name <> 'NATION_7'
      AND category IN (SELECT category FROM c WHERE n_name = 'NATION_7')""")
def shared_category_countries(t):
    facts = (
        t.orders.select("o_custkey", F.concat_ws("/", "o_orderpriority", "o_orderstatus").alias("category"))
        .distinct()
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("n_name", "category")
        .distinct()
    )
    inside = facts.filter("n_name = 'NATION_7'").select("category")
    return facts.filter("n_name <> 'NATION_7'").join(inside, "category", "left_semi").select("n_name").distinct()
