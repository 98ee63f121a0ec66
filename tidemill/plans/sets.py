"""Sorting, top-k, set operations and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.joins import not_in
from tidemill.plans.registry import query
from tidemill.plans.windows import CLASSES_SQL, INDEX_NAMES, MOVING_SQL, hourly_text, quality_average, scaled_indices
from tidemill.operators import windows as W
from tidemill.session import stage
from tidemill.sources.tables import BARS_SQL, HOURLY_SQL, NATION_MONTH_SQL, POLLUTANTS, daily_bars, day_text, monthly_nation_measures


@query("sort_multi", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort_multi(t):
    return t.customer.select("c_mktsegment", "c_acctbal", "c_custkey").orderBy("c_mktsegment", F.desc("c_acctbal"), "c_custkey")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def top_n(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(15)


@query("limit_n", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10")
def limit_n(t):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


def top_k_lists(lists, k=3):
    """The ``k`` most frequent names of several (name, count) tables as one tagged table."""
    tops = [
        df.orderBy(F.desc("n"), "name").limit(k).select(F.lit(tag).alias("list"), "name", "n") for tag, df in lists.items()
    ]
    return reduce(lambda a, b: a.unionAll(b), tops)


@query("top3_two_lists", """
    (SELECT 'part' AS list, p_name AS name, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
      GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 3)
    UNION ALL (SELECT 'supplier', s_name, count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 3)""")
def top3_two_lists(t):
    def counted(key, names, names_key, name):
        per_key = t.lineitem.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        joined = per_key.join(names, F.col(key) == F.col(names_key))
        return joined.groupBy(F.col(name).alias("name")).agg(F.sum("_n").alias("n"))

    return top_k_lists({
        "part": counted("l_partkey", t.part, "p_partkey", "p_name"),
        "supplier": counted("l_suppkey", t.supplier, "s_suppkey", "s_name"),
    })


@query("union_distinct", """
    SELECT n_name AS name, n_regionkey AS ref FROM nation UNION SELECT r_name, r_regionkey FROM region
    UNION SELECT 'NATION_' || s_nationkey, s_nationkey % 5 FROM supplier""")
def union_distinct(t):
    nations = t.nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("ref"))
    regions = t.region.select("r_name", "r_regionkey")
    seats = t.supplier.select(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")), F.col("s_nationkey") % 5)
    return nations.union(regions).union(seats).distinct()


@query("counts_with_total", """
    SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1 UNION SELECT 'All', count(*) FROM orders""")
def counts_with_total(t):
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return counts.union(counts.agg(F.sum("n")).select(F.lit("All"), "sum(n)")).distinct()


@query("mentions", """
    WITH b AS (SELECT o_custkey, o_orderpriority AS why FROM orders WHERE o_orderpriority = '1-URGENT'
               UNION SELECT o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')
    SELECT o_custkey, count(why) AS n_mentions FROM b GROUP BY 1 ORDER BY 1 LIMIT 15""")
def mentions(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey", F.col("o_orderpriority").alias("why"))
    builders = t.customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey", "c_mktsegment")
    building = t.orders.select("o_custkey").join(builders, F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", "c_mktsegment")
    tagged = urgent.union(building).distinct()
    return tagged.groupBy("o_custkey").agg(F.count("why").alias("n_mentions")).orderBy("o_custkey").limit(15)


def observed_and_predicted(observed, predicted, exact_hours=False):
    """Observed rows plus predictions for what has not been observed yet.

    By default a prediction needs an unobserved day and, separately, an unobserved hour;
    ``exact_hours`` tests the pair instead.
    """
    if exact_hours:
        return observed.union(predicted.join(observed, ["day", "hour"], "left_anti").select(*observed.columns)).distinct()
    left = not_in(predicted, "day", observed.select("day"))
    left = not_in(left, "hour", observed.select("hour"))
    return observed.union(left.select(*observed.columns)).distinct()


_SPLIT_DAY = "2024-01-20"
_AVG_COLS = ", ".join(f"avg({p}) OVER f AS avg_{p}" for p in POLLUTANTS)
_AVG_ROUND = ", ".join(f"round(avg_{p}, 6) AS avg_{p}" for p in POLLUTANTS)
_OBSERVED_SRC = f"SELECT * FROM ({HOURLY_SQL}) WHERE time_string < '{_SPLIT_DAY}' AND substr(time_string, 12, 5) < '20:00'"
_MART_HEAD = f"""
    WITH o AS ({MOVING_SQL.format(cols=_AVG_COLS, src=_OBSERVED_SRC)}),
         p AS ({MOVING_SQL.format(cols=_AVG_COLS, src=HOURLY_SQL)})
    SELECT day, hour, row_number::INTEGER AS row_number, {_AVG_ROUND} FROM (
      SELECT * FROM o UNION SELECT * FROM p WHERE """


def _observed_part(t):
    """Staging rows before the split day; the evening hours of every day are still missing."""
    raw = hourly_text(t)
    return raw.filter((F.col("time_string") < _SPLIT_DAY) & (F.substring("time_string", 12, 5) < "20:00"))


def _mart(t, exact_hours):
    observed, predicted = (stage(quality_average(r), "averages") for r in (_observed_part(t), hourly_text(t)))
    mart = observed_and_predicted(observed, predicted, exact_hours)
    return mart.withColumns({"day": day_text("day"), **{f"avg_{p}": F.round(f"avg_{p}", 6) for p in POLLUTANTS}})


@query("observed_predicted_union", _MART_HEAD + "p.day NOT IN (SELECT day FROM o) AND p.hour NOT IN (SELECT hour FROM o))")
def observed_predicted_union(t):
    return _mart(t, exact_hours=False)


@query("observed_predicted_exact", _MART_HEAD + "NOT EXISTS (SELECT 1 FROM o WHERE o.day = p.day AND o.hour = p.hour))")
def observed_predicted_exact(t):
    return _mart(t, exact_hours=True)


_CLASS_COLS = ", ".join(f"avg({n}_class) OVER f AS avg_{n}_class" for n in INDEX_NAMES)
_OBSERVED_CLASSES = f"SELECT * FROM ({CLASSES_SQL}) WHERE time_string < '{_SPLIT_DAY}' AND substr(time_string, 12, 5) < '20:00'"


@query("observed_predicted_danger", f"""
    WITH o AS ({MOVING_SQL.format(cols=_CLASS_COLS, src=_OBSERVED_CLASSES)}),
         p AS ({MOVING_SQL.format(cols=_CLASS_COLS, src=CLASSES_SQL)})
    SELECT day, hour, row_number::INTEGER AS row_number, {", ".join(f"round(avg_{n}_class, 6) AS avg_{n}_class" for n in INDEX_NAMES)} FROM (
      SELECT * FROM o UNION SELECT * FROM p
      WHERE p.day NOT IN (SELECT day FROM o) AND p.hour NOT IN (SELECT hour FROM o))""")
def observed_predicted_danger(t):
    names = [f"{n}_class" for n in INDEX_NAMES]
    averages = [
        stage(W.half_day_averages(W.danger_classes(scaled_indices(raw)), names), "dangers")
        for raw in (_observed_part(t), hourly_text(t))
    ]
    mart = observed_and_predicted(*averages)
    return mart.withColumns({"day": day_text("day"), **{f"avg_{n}": F.round(f"avg_{n}", 6) for n in names}})


def unpivot_wide(df, id_cols, variable, value):
    """Wide to long: one row per id and remaining column."""
    return df.unpivot(id_cols, [c for c in df.columns if c not in id_cols], variable, value)


@query("unpivot_wide", f"""
    WITH f AS (SELECT country, CAST(month AS VARCHAR) AS month, cases FROM ({NATION_MONTH_SQL}))
    SELECT c.country, m.month, coalesce(cases, 0) AS cases FROM (SELECT DISTINCT country FROM f) c
    CROSS JOIN (SELECT DISTINCT month FROM f) m LEFT JOIN f ON f.country = c.country AND f.month = m.month""")
def unpivot_wide_query(t):
    measures = monthly_nation_measures(t.orders, t.customer, t.nation).withColumn("month", day_text("month"))
    wide = stage(measures, "measures").groupBy("country").pivot("month").agg(F.sum("cases")).na.fill(0)
    return unpivot_wide(wide, ["country"], "month", "cases")


def explode_entries(documents):
    """One row per entry of the nested documents; a document without entries keeps one row of nulls."""
    exploded = documents.select("Date", F.explode_outer("Entries").alias("entry"))
    fields = [F.try_element_at("entry", F.lit(f)).alias(f) for f in ("Category", "Stock_Alias", "Data")]
    return exploded.select("Date", *fields)


def entry_properties(entries, names):
    """The JSON text of ``Data`` as one text column per property."""
    parsed = entries.withColumn("_p", F.from_json("Data", T.MapType(T.StringType(), T.StringType())))
    return parsed.select("*", *[F.try_element_at("_p", F.lit(n)).alias(n) for n in names]).drop("_p", "Data")


@query("explode_entries", f"""
    WITH days AS (SELECT DISTINCT day FROM ({BARS_SQL})), big AS (SELECT * FROM ({BARS_SQL}) WHERE volume > 75)
    SELECT CAST(d.day AS VARCHAR) AS day, ticker AS alias, CAST(volume AS VARCHAR) AS volume FROM days d LEFT JOIN big b ON b.day = d.day""")
def explode_entries_query(t):
    bars = daily_bars(t.events)
    entry = F.create_map(
        F.lit("Stock_Alias"), F.col("ticker"), F.lit("Category"), F.lit("site"),
        F.lit("Data"), F.to_json(F.struct(F.col("volume").cast("string").alias("Volume"))),
    )
    nested = bars.groupBy(day_text("day").alias("Date")).agg(F.collect_list(F.when(F.col("volume") > 75, entry)).alias("Entries"))
    flat = entry_properties(explode_entries(nested), ["Volume"])
    return flat.select(F.col("Date").alias("day"), F.col("Stock_Alias").alias("alias"), F.col("Volume").alias("volume"))


@query("json_props", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_props(t):
    parsed = t.events.select("event_id", F.from_json("props", T.MapType(T.StringType(), T.StringType())).alias("p"))
    return parsed.select("event_id", F.try_element_at("p", F.lit("k")).alias("k"), F.try_element_at("p", F.lit("missing")).alias("missing"))
