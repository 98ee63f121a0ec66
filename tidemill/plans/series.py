"""Time-series jobs over the monthly order counts per priority."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import timeseries as TS
from tidemill.plans.registry import query
from tidemill.plans.windows import holdout_split
from tidemill.session import stage
from tidemill.sources.tables import MONTHLY_SQL, day_text, monthly_series


def panel(t):
    """All months of the data."""
    return monthly_series(t.orders).select("series_id", "t", "y")


_PANEL = f"SELECT series_id, t, y FROM ({MONTHLY_SQL})"
_INDEXED = f"SELECT series_id, t, y, row_number() OVER (PARTITION BY series_id ORDER BY t) AS i FROM ({_PANEL})"


@query("acf", f"""
    WITH c AS (SELECT series_id, i, y - avg(y) OVER (PARTITION BY series_id) AS c FROM ({_INDEXED})),
    v AS (SELECT series_id, sum(c * c) AS v FROM c GROUP BY 1)
    SELECT a.series_id, (b.i - a.i)::INTEGER AS lag, round(sum(a.c * b.c) / any_value(v), 6) + 0.0 AS acf
    FROM c a JOIN c b ON a.series_id = b.series_id AND b.i - a.i BETWEEN 0 AND 60 JOIN v ON v.series_id = a.series_id GROUP BY 1, 2""")
def acf(t):
    return TS.acf(panel(t), 60).withColumn("acf", F.round("acf", 6))


@query("pacf", f"""
    WITH RECURSIVE c AS (SELECT series_id, i, y - avg(y) OVER (PARTITION BY series_id) AS c, count(*) OVER (PARTITION BY series_id) AS n FROM ({_INDEXED})),
    g AS (SELECT a.series_id, any_value(a.n) AS n, b.i - a.i AS k, sum(a.c * b.c) / (any_value(a.n) - (b.i - a.i)) AS g
          FROM c a JOIN c b ON a.series_id = b.series_id AND b.i - a.i BETWEEN 0 AND 40 GROUP BY a.series_id, b.i - a.i),
    r AS (SELECT series_id, any_value(n) AS n, list(g ORDER BY k) AS g, list_transform(list(g ORDER BY k), lambda x: x / list(g ORDER BY k)[1]) AS r FROM g GROUP BY 1),
    d(series_id, k, phi, spread) AS (
      SELECT series_id, 1, [r[2]], 1 - r[2] * r[2] FROM r
      UNION ALL SELECT series_id, k + 1, list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - last * phi[k + 1 - j]), [last]), spread * (1 - last * last)
      FROM (SELECT d.*, (r.r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: d.phi[j] * r.r[k + 2 - j]))) / spread AS last
            FROM d JOIN r ON r.series_id = d.series_id WHERE k < least(40, n // 2 - 1)))
    SELECT series_id, 0 AS lag, 1.0::DOUBLE AS pacf FROM r UNION ALL SELECT series_id, k, round(phi[k], 6) + 0.0 FROM d""")
def pacf(t):
    return TS.pacf(panel(t), 40).withColumn("pacf", F.round("pacf", 6))


@query("ar_fit_predict")
def ar_fit_predict(t):
    series = stage(panel(t), "panel")
    out = TS.ar_predict(series, TS.ar_fit(series, 12), 12, 12)
    return out.withColumn("t", day_text("t"))


@query("ar_two_lags", f"""
    WITH l AS (SELECT series_id, y, lag(y) OVER o AS a, lag(y, 2) OVER o AS b FROM ({_INDEXED}) WINDOW o AS (PARTITION BY series_id ORDER BY i)),
    f AS (SELECT * FROM l WHERE b IS NOT NULL),
    m AS (SELECT series_id, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, regr_sxx(a, a) AS aa, regr_sxx(b, b) AS bb, regr_sxy(a, b) AS ab, regr_sxy(y, a) AS ya, regr_sxy(y, b) AS yb FROM f GROUP BY 1),
    s AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS b1, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS b2 FROM m)
    SELECT series_id, round(my - b1 * ma - b2 * mb, 4) + 0.0 AS constant, round(b1, 6) + 0.0 AS lag_1, round(b2, 6) + 0.0 AS lag_2 FROM s""")
def ar_two_lags(t):
    """Least-squares autoregression with two lags, whose equations can be written out."""
    betas = TS.ar_fit(panel(t), 2)
    names = [("constant", 4), ("lag_1", 6), ("lag_2", 6)]
    return betas.select("series_id", *[(F.round(F.col("beta")[i], r) + 0.0).alias(n) for i, (n, r) in enumerate(names)])


@query("adf_first_stationary")
def adf_first_stationary(t):
    return TS.adf_first_stationary(panel(t))


def _regressed(y: str, x: str) -> str:
    """SQL for what is left of y after a regression on x within a series."""
    return f"{y} - avg({y}) OVER w - regr_slope({y}, {x}) OVER w * ({x} - avg({x}) OVER w)"


def _unit_root_sql(lags: int) -> str:
    """One lagged step after the other is taken out of the step and the level before the last regression."""
    names = [f"l{j}" for j in range(1, lags + 1)]
    rows = f"""SELECT series_id, d, v{"".join(f", {n}" for n in names)} FROM (
        SELECT series_id, d, v, i{"".join(f", lag(d, {j}) OVER o AS l{j}" for j in range(1, lags + 1))} FROM (
          SELECT series_id, i, y - lag(y) OVER o AS d, lag(y) OVER o AS v FROM ({_INDEXED}) WINDOW o AS (PARTITION BY series_id ORDER BY i)) WHERE d IS NOT NULL
        WINDOW o AS (PARTITION BY series_id ORDER BY i)) WHERE {" AND ".join(f"{n} IS NOT NULL" for n in ["v", *names])}"""
    while names:
        done, *names = names
        kept = ["d", "v", *names]
        rows = f"""SELECT series_id, {", ".join(f"{_regressed(n, done)} AS {n}" for n in kept)} FROM ({rows}) WINDOW w AS (PARTITION BY series_id)"""
    return f"""SELECT series_id, {lags} AS lags, round(b / sqrt((syy - b * b * sxx) / (n - {lags + 2}) / sxx), 5) + 0.0 AS statistic FROM (
        SELECT series_id, count(*) AS n, regr_slope(d, v) AS b, regr_sxx(d, v) AS sxx, regr_syy(d, v) AS syy FROM ({rows}) GROUP BY 1)"""


@query("unit_root_lags", " UNION ALL ".join(_unit_root_sql(k) for k in range(3)))
def unit_root_lags(t):
    """Unit-root statistic of each series with no, one and two lagged steps."""
    return TS.unit_root(panel(t), [0, 1, 2]).select("series_id", "lags", (F.round("statistic", 5) + 0.0).alias("statistic"))


@query("seasonal_decompose", f"""
    WITH m AS (SELECT *, (i - 1) % 12 AS phase, CASE WHEN count(*) OVER f = 13 THEN
        (sum(y) OVER f - (lag(y, 6) OVER w + lead(y, 6) OVER w) / 2) / 12 END AS trend FROM ({_INDEXED})
      WINDOW w AS (PARTITION BY series_id ORDER BY t), f AS (PARTITION BY series_id ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)),
    p AS (SELECT series_id, phase, avg(y / trend) AS raw FROM m GROUP BY 1, 2),
    s AS (SELECT series_id, phase, raw / avg(raw) OVER (PARTITION BY series_id) AS seasonal FROM p)
    SELECT m.series_id, CAST(t AS VARCHAR) AS t, y, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
      round(y / seasonal / trend, 6) AS residual FROM m JOIN s ON s.series_id = m.series_id AND s.phase = m.phase""")
def seasonal_decompose(t):
    out = TS.seasonal_decompose(panel(t)).drop("phase")
    return out.withColumns({"t": day_text("t"), **{c: F.round(c, 6) for c in ("trend", "seasonal", "residual")}})


_LAGS = ", ".join(f"lag(y, {i}) OVER w AS lag_{i}" for i in range(1, 13))


@query("lag_features", f"""
    SELECT series_id, CAST(t AS VARCHAR) AS t, y, {", ".join(f"lag_{i}" for i in range(1, 13))}, month(t)::INTEGER AS month
    FROM (SELECT series_id, t, y, {_LAGS} FROM ({_PANEL}) WINDOW w AS (PARTITION BY series_id ORDER BY t)) WHERE lag_12 IS NOT NULL""")
def lag_features(t):
    return TS.with_lags(panel(t), 12).withColumn("t", day_text("t"))


def forecast_with(t, estimator):
    """Train on all but the last year of every series, forecast that year."""
    series = stage(panel(t), "panel")
    train = holdout_split(series, "series_id", "t", 12).filter("part = 'train'").drop("part")
    model, assembler = TS.fit_lag_model(train, estimator, 12)
    forecast = TS.recursive_forecast(model, assembler, train, 12)
    actual = series.withColumnRenamed("y", "actual")
    return forecast.join(actual, ["series_id", "t"]).withColumn("t", day_text("t"))


@query("recursive_forecast")
def recursive_forecast(t):
    return forecast_with(t, LinearRegression(regParam=10.0, elasticNetParam=1.0, standardization=False))


@query("recursive_forecast_rf")
def recursive_forecast_rf(t):
    return forecast_with(t, RandomForestRegressor(numTrees=50, maxDepth=10, seed=42))


@query("recursive_forecast_gbt")
def recursive_forecast_gbt(t):
    return forecast_with(t, GBTRegressor(maxIter=20, seed=42))


@query("forecast_leaderboard", f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY t DESC) <= 12 AS test, lag(y, 12) OVER (PARTITION BY series_id ORDER BY t) AS naive
               FROM ({_PANEL})),
    m AS (SELECT series_id, avg(y) AS mean FROM r WHERE NOT test GROUP BY 1),
    l AS (SELECT 'seasonal naive' AS model, y, naive AS yhat FROM r WHERE test
          UNION ALL SELECT 'mean', y, mean FROM r JOIN m USING (series_id) WHERE test)
    SELECT model, round(avg((y - yhat) * (y - yhat)), 4) AS mse, round(avg(abs(y - yhat)), 4) AS mae FROM l GROUP BY 1""")
def forecast_leaderboard(t):
    by_time = Window.partitionBy("series_id").orderBy("t")
    parts = holdout_split(panel(t).withColumn("naive", F.lag("y", 12).over(by_time)), "series_id", "t", 12)
    means = parts.filter("part = 'train'").groupBy("series_id").agg(F.avg("y").alias("mean"))
    test = parts.filter("part = 'test'").join(means, "series_id")
    long = test.select("y", F.explode(F.create_map(F.lit("seasonal naive"), F.col("naive"), F.lit("mean"), F.col("mean"))).alias("model", "yhat"))
    out = TS.forecast_errors(long, "y", "yhat", "model")
    return out.withColumns({c: F.round(c, 4) for c in ("mse", "mae")})
