"""Time-series operators over panels: columns ``series_id``, ``t`` (a date) and ``y``.

One row per series and period, so a series is bounded by the calendar; the number of
series is not bounded and is what Spark distributes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.base import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemill.session import stage


def by_time() -> WindowSpec:
    return Window.partitionBy("series_id").orderBy("t")


def whole_series() -> WindowSpec:
    return Window.partitionBy("series_id")


def lag_products(df: DataFrame, max_lag: int) -> DataFrame:
    """Per series its length and the sums of products of centred values ``k`` periods apart, k = 0 .. max_lag.

    A series, bounded by the calendar, is gathered once as an array in order of time; all lags are sums over that.
    """
    gathered = df.groupBy("series_id").agg(F.array_sort(F.collect_list(F.struct("t", F.col("y").cast("double").alias("y")))).alias("r"), F.avg("y").alias("m"))
    centred = gathered.select("series_id", F.transform("r", lambda s: s["y"] - F.col("m")).alias("c"))

    def products(k: Column) -> Column:
        shifted = F.slice("c", k + 1, F.greatest(F.size("c") - k, F.lit(0)))
        return F.aggregate(F.zip_with(shifted, F.slice("c", F.lit(1), F.greatest(F.size("c") - k, F.lit(0))), lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda acc, v: acc + v)

    met = lambda k: F.when(k < F.size("c"), products(k))
    return centred.select("series_id", F.size("c").cast("long").alias("n"), F.transform(F.sequence(F.lit(0), F.lit(max_lag)), met).alias("s"))


def acf(df: DataFrame, max_lag: int) -> DataFrame:
    sums = lag_products(df, max_lag)
    ratios = F.transform("s", lambda v: F.try_divide(v, F.col("s")[0]))
    return sums.select("series_id", F.posexplode(ratios).alias("lag", "acf")).filter(F.col("acf").isNotNull())


def pacf(df: DataFrame, max_lag: int) -> DataFrame:
    """Partial autocorrelation from the Yule-Walker equations with autocovariances divided by n - k."""

    def levinson(frames):
        for pdf in frames:
            rows = []
            for series, n, s in zip(pdf["series_id"], pdf["n"], pdf["s"]):
                top = min(max_lag, n // 2 - 1)
                r = np.array([s[k] / (n - k) for k in range(top + 1)])
                r = r / r[0]
                phi, spread = np.zeros(0), 1.0
                rows.append((series, 0, 1.0))
                for k in range(1, top + 1):
                    last = (r[k] - phi @ r[k - 1:0:-1]) / spread if k > 1 else r[1]
                    phi = np.append(phi - last * phi[::-1], last)
                    spread *= 1 - last * last
                    rows.append((series, k, float(last)))
            yield pd.DataFrame(rows, columns=["series_id", "lag", "pacf"])

    return lag_products(df, max_lag).mapInPandas(levinson, "series_id string, lag int, pacf double")


def with_lags(df: DataFrame, lags: int, month: bool = True) -> DataFrame:
    """Lag features 1 .. lags and the month; the first rows of a series, which lack lags, are dropped."""
    lagged = df.select("*", *[F.lag("y", i).over(by_time()).alias(f"lag_{i}") for i in range(1, lags + 1)])
    complete = lagged.filter(F.col(f"lag_{lags}").isNotNull())
    return complete.withColumn("month", F.month("t")) if month else complete


def ar_fit(df: DataFrame, lags: int) -> DataFrame:
    """Least-squares autoregression with a constant per series.

    Spark sums the normal equations; each series then solves one small system.
    """
    names = ["one", *[f"lag_{i}" for i in range(1, lags + 1)]]
    x = with_lags(df, lags, month=False).withColumn("one", F.lit(1.0))
    gram = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[: i + 1]]
    moments = x.groupBy("series_id").agg(
        F.array(*gram).alias("xx"), F.array(*[F.sum(F.col(a) * F.col("y")) for a in names]).alias("xy")
    )
    size = len(names)

    def solve(frames):
        lower = np.tril_indices(size)
        for pdf in frames:
            out = []
            for series, xx, xy in zip(pdf["series_id"], pdf["xx"], pdf["xy"]):
                m = np.zeros((size, size))
                m[lower] = xx
                m = m + np.tril(m, -1).T
                out.append((series, np.linalg.lstsq(m, np.asarray(xy), rcond=None)[0].tolist()))
            yield pd.DataFrame(out, columns=["series_id", "beta"])

    return moments.mapInPandas(solve, "series_id string, beta array<double>")


def last_values(df: DataFrame, size: int) -> DataFrame:
    """Per series the last period and its most recent ``size`` values, newest first."""
    newest = Window.partitionBy("series_id").orderBy(F.desc("t"))
    recent = df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= size)
    return recent.groupBy("series_id").agg(
        F.max("t").alias("t"),
        F.transform(F.array_sort(F.collect_list(F.struct("_rn", "y"))), lambda s: s["y"]).alias("recent"),
    )


def ar_predict(df: DataFrame, betas: DataFrame, lags: int, steps: int = 12) -> DataFrame:
    """In-sample values and a recursive forecast of ``steps`` periods."""
    fitted = with_lags(df, lags, month=False).join(betas, "series_id").select(
        "series_id", "t", F.lit("fitted").alias("kind"),
        sum((F.col("beta")[i] * F.col(f"lag_{i}") for i in range(1, lags + 1)), F.col("beta")[0]).alias("yhat"),
    )
    start = last_values(df, lags).join(betas, "series_id")

    def extend(state: Column, _: Column) -> Column:
        slopes = F.slice("beta", 2, lags)
        terms = F.zip_with(slopes, F.slice(state, 1, lags), lambda b, v: b * v)
        following = F.aggregate(terms, F.col("beta")[0], lambda acc, v: acc + v)
        return F.concat(F.array(following), state)

    path = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("recent"), extend)
    ahead = F.reverse(F.slice(path, 1, steps))
    forecast = start.select("series_id", "t", F.posexplode(ahead).alias("i", "yhat")).select(
        "series_id", F.add_months("t", F.col("i") + 1).alias("t"), F.lit("forecast").alias("kind"), "yhat"
    )
    return fitted.unionByName(forecast)


def _lag_order(n: Column) -> Column:
    """Largest number of lagged steps that is tried for a series of n steps."""
    return F.least(F.ceil(12 * F.pow(n / 100, F.lit(0.25))), F.floor(n / 2) - 3).cast("int")


def unit_root_moments(df: DataFrame, keys: list[str], skip: Column | None = None) -> DataFrame:
    """Per series of (keys, t, v) what all its unit-root regressions need.

    Row t of the regression is the step to v(t), a one, the level before it (centred) and the lagged steps. ``gram``
    holds the sums of products of these, as the lower half of a matrix, over rows that have ``most`` lagged steps
    (or ``skip`` of them, if given); ``ahead`` holds the rows before, at most ``most`` of them, so that the regression of a
    lower order can be completed. A series is bounded by the calendar; series are what Spark distributes.
    """
    order = Window.partitionBy(*keys).orderBy("t")
    every = Window.partitionBy(*keys)
    steps = df.select(*keys, "t", (F.col("v") - F.lag("v").over(order)).alias("step"), (F.lag("v").over(order) - F.avg("v").over(every)).alias("level"))
    steps = steps.filter("step IS NOT NULL").withColumn("n", F.count(F.lit(1)).over(every)).withColumn("i", F.row_number().over(order) - 1)
    steps = stage(steps.withColumn("most", skip if skip is not None else _lag_order(F.col("n"))), "steps")
    width = (steps.agg(F.max("most")).first()[0] or 0) + 3
    lagged = [F.coalesce(F.lag("step", j).over(order), F.lit(0.0)) for j in range(1, width - 2)]
    rows = steps.select(*keys, "n", "i", "most", F.array("step", F.lit(1.0), "level", *lagged).alias("x"))
    full = F.col("i") >= F.col("most")
    sums = [F.sum(F.when(full, F.col("x")[a] * F.col("x")[b])) for a in range(width) for b in range(a + 1)]
    ahead = F.array_sort(F.collect_list(F.when(~full, F.struct("i", "x"))))
    return rows.groupBy(*keys).agg(F.first("n").alias("n"), F.first("most").alias("most"), F.array(*sums).alias("gram"), ahead.alias("ahead"))


class UnitRoot:
    """Regressions of nested lag orders from one matrix of sums of products, by one triangular factor."""

    def __init__(self, n: int, most: int, gram, ahead):
        width = int((np.sqrt(8 * len(gram) + 1) - 1) / 2)
        self.n, self.most = n, most
        whole = np.zeros((width, width))
        whole[np.tril_indices(width)] = [0.0 if v is None else v for v in gram]
        self.gram = (whole + np.tril(whole, -1).T)[:most + 3, :most + 3]
        self.ahead = [(r["i"], np.asarray(r["x"])[:most + 3]) for r in ahead]

    @staticmethod
    def factor(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Triangular factor of the regressors and the target's part in it: column k serves every order from k on."""
        low = np.linalg.cholesky(gram[1:, 1:])
        return low, np.linalg.solve(low, gram[1:, 0])

    def best_order(self) -> int:
        """Lag order by the Akaike criterion, all orders on the same rows: each adds one square to what is explained."""
        m = self.n - self.most
        _, part = self.factor(self.gram)
        left = self.gram[0, 0] - np.cumsum(part ** 2)[1:]
        return int(np.argmin([m * np.log(max(r, 1e-300) / m) + 2 * (k + 2) for k, r in enumerate(left)]))

    def statistic(self, order: int) -> tuple[float, int]:
        """t statistic of the level with ``order`` lagged steps and all rows that have them, and their number."""
        gram = self.gram[:order + 3, :order + 3].copy()
        for i, x in self.ahead:
            if i >= order:
                gram += np.outer(x[:order + 3], x[:order + 3])
        m = self.n - order
        low, part = self.factor(gram)
        beta = np.linalg.solve(low.T, part)
        error = np.linalg.solve(low, np.eye(len(low))[1])  # its square is the level's entry of the inverse
        scale = (gram[0, 0] - part @ part) / (m - len(beta))
        return float(beta[1] / np.sqrt(scale * (error @ error))), m


def critical_value(m: int) -> float:
    # fixed values: MacKinnon (2010) response surface, constant only, 5 percent
    return -2.86154 - 2.8903 / m - 4.234 / m**2 - 40.04 / m**3


def _tested(moments: DataFrame, keys: list[str], orders) -> DataFrame:
    """One row for each series and lag order that ``orders(test)`` names; series too short or without variation have null statistics."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in moments.select(*keys).schema)

    def run(frames):
        for pdf in frames:
            out = []
            for one in pdf.to_dict("records"):
                named = [one[k] for k in keys]
                test = UnitRoot(one["n"], max(one["most"], 0), one["gram"], one["ahead"])
                try:
                    found = [(k, *test.statistic(k)) for k in orders(test)] if one["most"] >= 0 else [(None, None, None)]
                except np.linalg.LinAlgError:
                    found = [(None, None, None)]
                out += [(*named, k, s if s is not None and np.isfinite(s) else None, critical_value(m) if m else None) for k, s, m in found]
            yield pd.DataFrame(out, columns=[*keys, "lags", "statistic", "critical"]).astype({"lags": "Int32", "statistic": "Float64", "critical": "Float64"})

    return moments.mapInPandas(run, f"{kinds}, lags int, statistic double, critical double")


def unit_root(df: DataFrame, lags: list[int]) -> DataFrame:
    """Augmented Dickey-Fuller t statistic (constant) of each series (series_id, t, y) for each of the given numbers of lagged steps."""
    rows = df.select("series_id", "t", F.col("y").cast("double").alias("v"))
    return _tested(unit_root_moments(rows, ["series_id"], F.lit(max(lags))), ["series_id"], lambda test: lags)


def differences(df: DataFrame, max_order: int) -> DataFrame:
    """The series (order 0) and its differences y(t) - y(t - i) in long form: series_id, t, order, v."""
    orders = F.sequence(F.lit(0), F.lit(max_order))
    columns = [F.col("y").cast("double"), *[(F.col("y") - F.lag("y", i).over(by_time())).cast("double") for i in range(1, max_order + 1)]]
    differenced = df.select("series_id", "t", F.array(*columns).alias("d"))
    long = differenced.select("series_id", "t", F.explode(F.arrays_zip(orders.alias("order"), F.col("d").alias("v"))).alias("z"))
    return long.select("series_id", "t", F.col("z.order").alias("order"), F.col("z.v").alias("v")).filter("v IS NOT NULL")


def adf_first_stationary(df: DataFrame, max_order: int = 12) -> DataFrame:
    """Per series the unit-root test of the series (order 0) and of its differences y(t) - y(t - i), lag order by the
    Akaike criterion, marking the first stationary order. Spark sums one matrix per series and difference; a task
    solves that alone."""
    keys = ["series_id", "order"]
    tested = _tested(unit_root_moments(differences(df, max_order), keys), keys, lambda test: [test.best_order()]).drop("lags")
    tested = tested.withColumn("stationary", F.col("statistic") < F.col("critical"))
    first = F.min(F.when(F.col("stationary") & (F.col("order") > 0), F.col("order"))).over(whole_series())
    return tested.withColumn("first_order", first)


def seasonal_decompose(df: DataFrame, period: int = 12) -> DataFrame:
    """Multiplicative decomposition: centred moving average, mean ratio per phase, remainder."""
    half = period // 2
    full = by_time().rowsBetween(-half, half)
    ends = F.lag("y", half).over(by_time()) + F.lead("y", half).over(by_time())
    trend = F.when(
        F.count("y").over(full) == period + 1, (F.sum("y").over(full) - ends / 2) / period
    )
    staged = df.select("series_id", "t", "y", ((F.row_number().over(by_time()) - 1) % period).alias("phase"), trend.alias("trend"))
    ratios = staged.withColumn("ratio", F.try_divide("y", "trend"))
    per_phase = ratios.groupBy("series_id", "phase").agg(F.avg("ratio").alias("raw"))
    seasonal = per_phase.withColumn("seasonal", F.try_divide(F.col("raw"), F.avg("raw").over(whole_series()))).drop("raw")
    joined = staged.join(seasonal, ["series_id", "phase"])
    return joined.withColumn("residual", F.try_divide(F.try_divide("y", "seasonal"), F.col("trend")))


def fit_lag_model(df: DataFrame, estimator: Estimator, lags: int = 12, month: bool = True) -> tuple[Model, VectorAssembler]:
    """One model pooled over all series on lag features and the month."""
    inputs = [f"lag_{i}" for i in range(1, lags + 1)] + (["month"] if month else [])
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    rows = assembler.transform(with_lags(df, lags, month).withColumn("label", F.col("y").cast("double")))
    return estimator.fit(rows.select("features", "label")), assembler


def recursive_forecast(model: Model, assembler: VectorAssembler, df: DataFrame, steps: int = 12) -> DataFrame:
    """Forecast all series step by step, each prediction feeding the lags of the next step.

    The state is one row per series; it is written out after each step so that the plan stays short.
    """
    lags = sum(c.startswith("lag_") for c in assembler.getInputCols())
    state = stage(last_values(df, lags).withColumn("path", F.array().cast("array<double>")), "forecast")
    for _ in range(steps):
        following = state.withColumn("t", F.add_months("t", 1))
        features = following.select(
            "*", *[F.col("recent")[i - 1].alias(f"lag_{i}") for i in range(1, lags + 1)], F.month("t").alias("month")
        )
        predicted = model.transform(assembler.transform(features)).select("series_id", "t", "recent", "path", "prediction")
        state = stage(predicted.select(
            "series_id", "t",
            F.slice(F.concat(F.array("prediction"), "recent"), 1, lags).alias("recent"),
            F.concat("path", F.array("prediction")).alias("path"),
        ), "forecast")
    unrolled = state.select("series_id", "t", F.posexplode("path").alias("i", "yhat"))
    return unrolled.select("series_id", F.add_months("t", F.col("i") + 1 - steps).alias("t"), "yhat")


def forecast_errors(df: DataFrame, y: str, yhat: str, by: str) -> DataFrame:
    """Mean squared and mean absolute error per model, best first."""
    gap = F.col(y) - F.col(yhat)
    return df.groupBy(by).agg(F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae")).orderBy("mse")
