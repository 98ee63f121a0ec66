"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import windows as W
from tidemill.operators.ordering import global_running_sum
from tidemill.operators.rates import MEASURES, extract_wide, rates_job, rates_pipeline
from tidemill.plans.registry import query
from tidemill.plans.rows import split_iso, typed_measures
from tidemill.session import scratch_path, stage
from tidemill.sources import files
from tidemill.sources.tables import (
    BARS_SQL, HOURLY_SQL, MONTHLY_SQL, NATION_MONTH_SQL, POLLUTANTS, daily_bars, day_text, hourly_measures, monthly_nation_measures,
    monthly_series,
)

RATES_SQL = f"""
    WITH m AS (SELECT * FROM ({NATION_MONTH_SQL})),
    r AS (SELECT *, deaths::DOUBLE / nullif(cases, 0) AS mortality_rate, recoveries::DOUBLE / nullif(cases, 0) AS recovery_rate FROM m),
    c AS (SELECT *, mortality_rate / nullif(lag(mortality_rate) OVER w, 0) - 1 AS mortality_rate_change,
                 recovery_rate / nullif(lag(recovery_rate) OVER w, 0) - 1 AS recovery_rate_change
          FROM r WINDOW w AS (PARTITION BY country ORDER BY month))"""


def rates(t):
    """The measures with rates and their changes; dropping nulls also drops each key's first row and zero rates."""
    measures = monthly_nation_measures(t.orders, t.customer, t.nation)
    return W.add_rates(measures, "country", "month", "cases", {"deaths": "mortality_rate", "recoveries": "recovery_rate"})


@query("rate_change", RATES_SQL + """
    SELECT country, CAST(month AS VARCHAR) AS month, cases, deaths, recoveries, round(mortality_rate, 6) AS mortality_rate,
      round(recovery_rate, 6) AS recovery_rate, round(mortality_rate_change, 6) AS mortality_rate_change,
      round(recovery_rate_change, 6) AS recovery_rate_change
    FROM c WHERE mortality_rate_change IS NOT NULL AND recovery_rate_change IS NOT NULL""")
def rate_change(t):
    done = rates(t).na.drop().withColumn("month", day_text("month"))
    rounded = {c: F.round(c, 6) for c in done.columns if "rate" in c}
    return done.withColumns(rounded)


@query("rates_pipeline", f"""
    WITH m AS (SELECT country, CASE WHEN month > DATE '1995-01-01' THEN month END AS d, CASE WHEN recoveries <> 2 THEN cases END AS cases, deaths, recoveries
               FROM ({NATION_MONTH_SQL})),
    r AS (SELECT *, deaths::DOUBLE / nullif(cases, 0) AS mr, recoveries::DOUBLE / nullif(cases, 0) AS rr FROM m),
    c AS (SELECT *, mr / nullif(lag(mr) OVER w, 0) - 1 AS mc, rr / nullif(lag(rr) OVER w, 0) - 1 AS rc FROM r WINDOW w AS (PARTITION BY country ORDER BY d NULLS FIRST))
    SELECT upper(country) AS country, CAST(d AS VARCHAR) AS date, cases::INTEGER AS cases, deaths::INTEGER AS deaths, recoveries::INTEGER AS recoveries, true AS sanity_check,
      round(mr, 6) AS mortality_rate, round(rr, 6) AS recovery_rate, round(mc, 6) AS mortality_rate_change, round(rc, 6) AS recovery_rate_change
    FROM c WHERE d IS NOT NULL AND mc IS NOT NULL AND rc IS NOT NULL""")
def rates_pipeline_query(t):
    """Text measures with a malformed date per country, unreadable counts and every row twice."""
    m = monthly_nation_measures(t.orders, t.customer, t.nation)
    date = day_text("month")
    texts = m.select(
        F.lower("country").alias("country"),
        F.when(F.col("month") > F.lit("1995-01-01").cast("date"), date).otherwise(F.concat(F.lit("x"), date)).alias("date"),
        F.when(F.col("recoveries") == 2, "n/a").otherwise(F.col("cases").cast("string")).alias("cases"),
        F.col("deaths").cast("string").alias("deaths"), F.col("recoveries").cast("string").alias("recoveries"),
    )
    done, _ = rates_pipeline(texts.unionAll(texts))
    return done.withColumns({"date": day_text("date"), **{c: F.round(c, 6) for c in done.columns if "rate" in c}})


def wide_files(t):
    """The measures as three wide CSV files: a row for each country, a column for each month."""
    measures = stage(monthly_nation_measures(t.orders, t.customer, t.nation).withColumn("month", day_text("month")), "measures")
    paths = {m: scratch_path(t.spark, m) for m in MEASURES}
    for m, path in paths.items():
        files.write_csv(measures.groupBy("country").pivot("month").agg(F.sum(m)), path)
    return paths


_GRID_SQL = f"""f AS (SELECT country, CAST(month AS VARCHAR) AS date, cases, deaths, recoveries FROM ({NATION_MONTH_SQL})),
    g AS (SELECT * FROM (SELECT DISTINCT country FROM f) CROSS JOIN (SELECT DISTINCT date FROM f) LEFT JOIN f USING (country, date))"""


@query("rates_extract", f"WITH {_GRID_SQL} SELECT country, date, cases::INTEGER AS cases, deaths::INTEGER AS deaths, recoveries::INTEGER AS recoveries, true AS all_equal FROM g")
def rates_extract(t):
    """Three wide files, read with inferred types, counted, unpivoted and joined."""
    long, counts = extract_wide(t.spark, wide_files(t))
    return long.select("country", "date", *MEASURES).join(F.broadcast(counts.agg(F.bool_and("all_equal").alias("all_equal"))))


@query("rates_report", f"WITH {_GRID_SQL} SELECT count(*) AS processed, count(*) FILTER (cases IS NULL OR deaths IS NULL OR recoveries IS NULL) AS failed, true AS all_equal FROM g")
def rates_report(t):
    """Rows that the whole job has processed and those that failed a check."""
    return rates_job(t.spark, wide_files(t), scratch_path(t.spark, "rates-table"))


@query("rates_table", f"""
    WITH {_GRID_SQL},
    r AS (SELECT *, deaths::DOUBLE / nullif(cases, 0) AS mr, recoveries::DOUBLE / nullif(cases, 0) AS rr FROM g),
    c AS (SELECT *, mr / nullif(lag(mr) OVER w, 0) - 1 AS mc, rr / nullif(lag(rr) OVER w, 0) - 1 AS rc FROM r WINDOW w AS (PARTITION BY country ORDER BY date))
    SELECT upper(country) AS country, date, cases::INTEGER AS cases, round(mr, 6) AS mortality_rate, round(rr, 6) AS recovery_rate, round(mc, 6) AS mortality_rate_change,
      round(rc, 6) AS recovery_rate_change FROM c WHERE mc IS NOT NULL AND rc IS NOT NULL""")
def rates_table(t):
    """The CSV table that the whole job writes, read again."""
    target = scratch_path(t.spark, "rates-table")
    rates_job(t.spark, wide_files(t), target)
    done = files.read_csv_inferred(t.spark, target).withColumn("date", day_text("date"))
    return done.select("country", "date", "cases", *[F.round(c, 6).alias(c) for c in done.columns if "rate" in c])


@query("running_volume", f"""
    SELECT ticker, CAST(day AS VARCHAR) AS day, volume,
      (sum(volume) OVER (PARTITION BY ticker ORDER BY day ROWS UNBOUNDED PRECEDING))::BIGINT AS running_volume FROM ({BARS_SQL})""")
def running_volume(t):
    bars = daily_bars(t.events).select("ticker", "day", "volume")
    return W.running_sum(bars, "ticker", ["day"], "volume", "running_volume").withColumn("day", day_text("day"))


MOVING_SQL = "SELECT substr(time_string, 1, 10) AS day, substr(time_string, 12, 5) AS hour, {cols}, " \
    "row_number() OVER w AS row_number FROM ({src}) " \
    "WINDOW w AS (PARTITION BY substr(time_string, 1, 10) ORDER BY time_string), " \
    "f AS (PARTITION BY substr(time_string, 1, 10) ORDER BY time_string ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) " \
    "QUALIFY row_number IN (12, 24)"


def hourly_text(t):
    raw = hourly_measures(t.events)
    return raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])


def quality_average(raw):
    return W.half_day_averages(typed_measures(raw), POLLUTANTS)


@query("moving_average_halfday", "SELECT day, hour, row_number::INTEGER AS row_number, " + ", ".join(
    f"round(avg_{p}, 6) AS avg_{p}" for p in POLLUTANTS) + " FROM (" + MOVING_SQL.format(
    cols=", ".join(f"avg({p}) OVER f AS avg_{p}" for p in POLLUTANTS), src=HOURLY_SQL) + ")")
def moving_average_halfday(t):
    out = quality_average(hourly_text(t)).withColumn("day", day_text("day"))
    return out.withColumns({f"avg_{p}": F.round(f"avg_{p}", 6) for p in POLLUTANTS})


def scaled_indices(raw):
    """Typed hourly rows whose measures play the air-quality indices, with an overall one (their greatest value)."""
    typed = typed_measures(raw)
    return typed.withColumn("overall", F.greatest(*POLLUTANTS))


def _bands_case(name, bands):
    arms = " ".join(f"WHEN {name} >= {lo} AND {name} < {hi} THEN {i}" for i, (lo, hi) in enumerate(bands, 1))
    return f"CASE {arms} ELSE 6 END"


INDEX_NAMES = list(W.AQI_BANDS)
CLASSES_SQL = "SELECT time_string, " + ", ".join(
    f"{_bands_case(n, b)} AS {n}_class" for n, b in W.AQI_BANDS.items()
) + f" FROM (SELECT *, greatest(pm10, pm2_5, nitrogen_dioxide, sulphur_dioxide, ozone) AS overall FROM ({HOURLY_SQL}))"


@query("aqi_classes", "SELECT substr(time_string, 1, 10) AS day, substr(time_string, 12, 5) AS hour, " + ", ".join(
    f"{n}_class" for n in INDEX_NAMES) + f" FROM ({CLASSES_SQL})")
def aqi_classes(t):
    return W.danger_classes(scaled_indices(hourly_text(t))).withColumn("day", day_text("day"))


@query("danger_average_halfday", "SELECT day, hour, row_number::INTEGER AS row_number, " + ", ".join(
    f"round(avg_{n}_class, 6) AS avg_{n}_class" for n in INDEX_NAMES) + " FROM (" + MOVING_SQL.format(
    cols=", ".join(f"avg({n}_class) OVER f AS avg_{n}_class" for n in INDEX_NAMES), src=CLASSES_SQL) + ")")
def danger_average_halfday(t):
    names = [f"{n}_class" for n in INDEX_NAMES]
    out = W.half_day_averages(W.danger_classes(scaled_indices(hourly_text(t))), names)
    return out.withColumns({"day": day_text("day"), **{f"avg_{n}": F.round(f"avg_{n}", 6) for n in names}})


RETURNS_SQL = f"""SELECT *, close / lag(close) OVER (PARTITION BY ticker ORDER BY day) - 1 AS ret FROM ({BARS_SQL})"""


def daily_returns(events):
    """Daily bars with the close-to-close return of each ticker."""
    return W.percent_change(daily_bars(events), "ticker", "day", "close", "ret")


@query("daily_returns", f"SELECT ticker, CAST(day AS VARCHAR) AS day, close, round(ret, 6) AS ret FROM ({RETURNS_SQL})")
def daily_returns_query(t):
    return daily_returns(t.events).select("ticker", day_text("day").alias("day"), "close", F.round("ret", 6).alias("ret"))


@query("rolling_volatility", f"""
    SELECT ticker, CAST(day AS VARCHAR) AS day,
      CASE WHEN count(ret) OVER f = 20 THEN round(stddev_samp(ret) OVER f, 6) END AS volatility
    FROM ({RETURNS_SQL}) WINDOW f AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def rolling_volatility(t):
    out = W.rolling(daily_returns(t.events), "ticker", "day", "ret", 20, F.stddev_samp, "volatility")
    return out.select("ticker", day_text("day").alias("day"), F.round("volatility", 6).alias("volatility"))


@query("rolling_mean", """
    SELECT o_orderpriority, CAST(day AS VARCHAR) AS day, n,
      CASE WHEN count(n) OVER f = 50 THEN round(avg(n) OVER f, 6) END AS moving_average
    FROM (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2)
    WINDOW f AS (PARTITION BY o_orderpriority ORDER BY day ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""")
def rolling_mean(t):
    daily = t.orders.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    out = W.rolling(daily, "o_orderpriority", "day", "n", 50, F.avg, "moving_average")
    return out.withColumns({"day": day_text("day"), "moving_average": F.round("moving_average", 6)})


@query("forward_fill", f"""
    WITH b AS (SELECT ticker, day, CASE WHEN volume > 66 THEN close END AS close FROM ({BARS_SQL}))
    SELECT ticker, CAST(day AS VARCHAR) AS day, close,
      last_value(close IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY day ROWS UNBOUNDED PRECEDING) AS filled FROM b""")
def forward_fill(t):
    bars = daily_bars(t.events).select("ticker", "day", F.when(F.col("volume") > 66, F.col("close")).alias("close"))
    out = W.forward_fill(bars.withColumn("filled", F.col("close")), "ticker", "day", ["filled"])
    return out.withColumn("day", day_text("day"))


@query("cumulative_returns", f"""
    SELECT ticker, CAST(day AS VARCHAR) AS day, round(sum(ret) OVER (PARTITION BY ticker ORDER BY day), 6) AS cumulative_return
    FROM ({RETURNS_SQL}) WHERE ret IS NOT NULL""")
def cumulative_returns(t):
    summed = W.running_sum(daily_returns(t.events).filter("ret IS NOT NULL"), "ticker", ["day"], "ret", "cumulative_return")
    return summed.select("ticker", day_text("day").alias("day"), F.round("cumulative_return", 6).alias("cumulative_return"))


def midnight_rollover(df, order, hour_col, base_day, out="day"):
    """Date of rows that carry only a time of day: the base day plus the midnights seen so far."""
    flagged = df.withColumn("_midnight", (F.col(hour_col) == "00:00").cast("long"))
    counted = global_running_sum(flagged, order, "_midnight", "_rolled")
    day = F.date_add(F.lit(base_day).cast("date"), F.col("_rolled").cast("int"))
    return counted.withColumn(out, day).drop("_midnight", "_rolled")


@query("midnight_rollover", """
    WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS h FROM events)
    SELECT strftime(h, '%H:%M') AS hour, CAST((DATE '2023-12-31' + (sum((strftime(h, '%H:%M') = '00:00')::INTEGER)
      OVER (ORDER BY h ROWS UNBOUNDED PRECEDING))::INTEGER) AS VARCHAR) AS day FROM h""")
def midnight_rollover_query(t):
    hours = t.events.select(F.date_format("ts", "yyyy-MM-dd'T'HH:00").alias("source_order")).distinct()
    entries = hours.withColumn("hour", split_iso(F.col("source_order"))[1])
    rolled = midnight_rollover(entries, ["source_order"], "hour", "2023-12-31")
    return rolled.select("hour", day_text("day").alias("day"))


@query("downsample_series", """
    WITH r AS (SELECT event_type, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn,
               count(*) OVER (PARTITION BY event_type) AS n FROM events)
    SELECT event_type, event_id, value FROM r WHERE (rn - 1) % ceil(n / 1000)::BIGINT = 0""")
def downsample_series(t):
    points = t.events.select("event_type", "event_id", "ts", "value")
    return W.downsample(points, "event_type", ["ts", "event_id"]).select("event_type", "event_id", "value")


@query("series_diff", f"""
    SELECT series_id, CAST(t AS VARCHAR) AS t, y - lag(y, 1) OVER w AS diff_1, y - lag(y, 12) OVER w AS diff_12
    FROM ({MONTHLY_SQL}) WINDOW w AS (PARTITION BY series_id ORDER BY t)""")
def series_diff(t):
    w = Window.partitionBy("series_id").orderBy("t")
    return monthly_series(t.orders).select(
        "series_id", day_text("t").alias("t"),
        *[(F.col("y") - F.lag("y", i).over(w)).alias(f"diff_{i}") for i in (1, 12)],
    )


def holdout_split(df, key, order, n):
    """Mark the last ``n`` points of each series as test, the rest as train."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("part", F.when(F.row_number().over(w) <= n, "test").otherwise("train"))


@query("holdout_last_n", f"""
    SELECT series_id, CAST(t AS VARCHAR) AS t, y,
      CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY t DESC) <= 12 THEN 'test' ELSE 'train' END AS part
    FROM ({MONTHLY_SQL})""")
def holdout_last_n(t):
    return holdout_split(monthly_series(t.orders).drop("revenue"), "series_id", "t", 12).withColumn("t", day_text("t"))
