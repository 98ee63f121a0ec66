"""Input tables and the domain tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Which event type stands for which measure of the hourly air-quality chain.
POLLUTANT_OF_TYPE = {
    "click": "pm10",
    "error": "pm2_5",
    "purchase": "nitrogen_dioxide",
    "signup": "sulphur_dioxide",
    "view": "ozone",
}
POLLUTANTS = list(POLLUTANT_OF_TYPE.values())


class Tables:
    """Lazy access to the parquet tables of one scale folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def day_text(c) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd")


def daily_bars(events: DataFrame) -> DataFrame:
    """Open, high, low, close and volume per event type and day.

    One pass with map-side partial aggregation; the result is bounded by types x calendar days.
    """
    first = F.struct("ts", "event_id")
    return events.groupBy(F.col("event_type").alias("ticker"), F.to_date("ts").alias("day")).agg(
        F.min_by("value", first).alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", first).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


BARS_SQL = """
    SELECT event_type AS ticker, CAST(ts AS DATE) AS day,
           arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
           arg_max(value, (ts, event_id)) AS close, count(*) AS volume
    FROM events GROUP BY 1, 2
"""


def hourly_measures(events: DataFrame) -> DataFrame:
    """One row per hour with the mean value of each event type as a pollutant column."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    grouped = events.groupBy(hour.alias("hour_ts")).pivot("event_type", EVENT_TYPES).agg(F.avg("value"))
    return grouped.select(
        F.date_format("hour_ts", "yyyy-MM-dd'T'HH:mm").alias("time_string"),
        *[F.col(t).alias(POLLUTANT_OF_TYPE[t]) for t in EVENT_TYPES],
    )


HOURLY_SQL = """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M') AS time_string,
           avg(value) FILTER (event_type = 'click') AS pm10,
           avg(value) FILTER (event_type = 'error') AS pm2_5,
           avg(value) FILTER (event_type = 'purchase') AS nitrogen_dioxide,
           avg(value) FILTER (event_type = 'signup') AS sulphur_dioxide,
           avg(value) FILTER (event_type = 'view') AS ozone
    FROM events GROUP BY 1
"""


def monthly_series(orders: DataFrame) -> DataFrame:
    """Order count and revenue per priority and month: a panel of equally spaced series."""
    return orders.groupBy(
        F.col("o_orderpriority").alias("series_id"),
        F.trunc("o_orderdate", "month").alias("t"),
    ).agg(F.count(F.lit(1)).cast("double").alias("y"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))


MONTHLY_SQL = """
    SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS t,
           CAST(count(*) AS DOUBLE) AS y, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS revenue
    FROM orders GROUP BY 1, 2
"""


def monthly_nation_measures(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Per nation and month: all orders (cases), finished ones (recoveries) and pending ones (deaths).

    Orders are counted per customer and month before the join, so the shuffle carries counts only.
    """
    per_customer = orders.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("cases"),
        F.count_if(F.col("o_orderstatus") == "P").alias("deaths"),
        F.count_if(F.col("o_orderstatus") == "F").alias("recoveries"),
    )
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"), "month")
        .agg(*[F.sum(m).alias(m) for m in ("cases", "deaths", "recoveries")])
    )


NATION_MONTH_SQL = """
    SELECT n_name AS country, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
           count(*) AS cases, count(*) FILTER (o_orderstatus = 'P') AS deaths,
           count(*) FILTER (o_orderstatus = 'F') AS recoveries
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY 1, 2
"""
