"""Portfolio-risk jobs: event types are the assets, their daily bars the prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.hashing import normal_hash_sql
from tidemill.operators import risk as R
from tidemill.plans.registry import query
from tidemill.plans.windows import RETURNS_SQL, daily_returns
from tidemill.sources.tables import daily_bars, day_text

DRAWS = 10_000


@query("var_cvar", f"""
    WITH r AS (SELECT ret FROM ({RETURNS_SQL}) WHERE ret IS NOT NULL), n AS (SELECT floor(count(*) * 0.05)::BIGINT AS m FROM r),
    o AS (SELECT ret, row_number() OVER (ORDER BY ret) AS rn FROM r)
    SELECT round((SELECT quantile_cont(ret, 0.05) FROM r), 6) AS var, round((SELECT avg(ret) FROM o, n WHERE rn <= m), 6) AS cvar""")
def var_cvar(t):
    out = R.tail_risk(daily_returns(t.events), "ret")
    return out.select(F.round("var", 6).alias("var"), F.round("cvar", 6).alias("cvar"))


_LATEST_SQL = f"SELECT ticker, arg_max(ret, day) AS ret FROM ({RETURNS_SQL}) GROUP BY 1"


@query("scenario_table", f"""
    WITH l AS ({_LATEST_SQL}), s AS (SELECT 2 * stddev_pop(ret) AS sd, count(*) AS n FROM l)
    SELECT d.draw, round(sum((l.ret + s.sd * {normal_hash_sql("mc", "d.draw", "l.ticker")}) * (1 / s.n)), 6) AS portfolio_return
    FROM range({DRAWS}) d(draw), l, s GROUP BY 1""")
def scenario_table(t):
    draws = R.scenario_table(latest_returns(t), "ticker", "ret", DRAWS, "mc")
    return draws.withColumn("portfolio_return", F.round("portfolio_return", 6))


def latest_returns(t):
    return R.latest_values(daily_returns(t.events), "ticker", "day", "ret")


_LIKELIHOOD = {"1-URGENT": "Almost Certain", "2-HIGH": "Likely", "3-MEDIUM": "Possible", "4-NOT SPECIFIED": "Unlikely", "5-LOW": "Rare"}
_IMPACT_STEPS = [(100_000, "Insignificant"), (200_000, "Minor"), (300_000, "Moderate"), (400_000, "Major")]


def order_risks(orders):
    """Each order as a risk: its priority gives the likelihood, its price the impact."""
    likelihood = F.element_at(F.create_map(*[F.lit(x) for kv in _LIKELIHOOD.items() for x in kv]), F.col("o_orderpriority"))
    impact = F.coalesce(*[F.when(F.col("o_totalprice") < cut, name) for cut, name in _IMPACT_STEPS], F.lit("Catastrophic"))
    return orders.select(F.col("o_orderkey").alias("risk"), likelihood.alias("likelihood"), impact.alias("impact"), "o_orderstatus")


def _case(column, mapping):
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in mapping.items()) + " END"


_RISKS_SQL = f"""SELECT o_orderkey AS risk, o_orderstatus, {_case("o_orderpriority", _LIKELIHOOD)} AS likelihood,
    CASE {" ".join(f"WHEN o_totalprice < {c} THEN '{n}'" for c, n in _IMPACT_STEPS)} ELSE 'Catastrophic' END AS impact FROM orders"""


def _score_sql(likelihood="likelihood", impact="impact"):
    return f"({_case(likelihood, R.LIKELIHOOD_SCALE)} * {_case(impact, R.IMPACT_SCALE)})"


@query("risk_matrix", f"""
    WITH l(likelihood) AS (VALUES {", ".join(f"('{k}')" for k in R.LIKELIHOOD_SCALE)}), i(impact) AS (VALUES {", ".join(f"('{k}')" for k in R.IMPACT_SCALE)}),
    c AS (SELECT likelihood, impact, count(*) AS n FROM ({_RISKS_SQL}) GROUP BY 1, 2)
    SELECT l.likelihood, i.impact, {_score_sql("l.likelihood", "i.impact")} AS score, coalesce(n, 0) AS n_risks
    FROM l CROSS JOIN i LEFT JOIN c ON c.likelihood = l.likelihood AND c.impact = i.impact""")
def risk_matrix(t):
    return R.risk_matrix(order_risks(t.orders))


@query("risk_scores", f"SELECT risk, likelihood, impact, {_score_sql()} AS score FROM ({_RISKS_SQL})")
def risk_scores(t):
    return R.risk_score(order_risks(t.orders)).select("risk", "likelihood", "impact", "score")


def order_responses(risks):
    action = (
        F.when((F.col("o_orderstatus") == "P") & (F.col("impact") == "Insignificant"), "avoid")
        .when(F.col("o_orderstatus") == "P", "transfer")
        .when((F.col("o_orderstatus") == "O") & (F.col("likelihood") == "Almost Certain"), "mitigate")
        .when(F.col("o_orderstatus") == "O", "accept")
    )
    return risks.select(
        "risk", action.alias("action"), F.lit("Possible").alias("new_likelihood"),
        F.when(F.col("impact") == "Catastrophic", "Major").alias("new_impact"),
    ).filter("action IS NOT NULL")


@query("risk_responses", f"""
    WITH r AS (SELECT *, o_orderstatus = 'O' AND likelihood = 'Almost Certain' AS m FROM ({_RISKS_SQL})
               WHERE NOT (o_orderstatus = 'P' AND impact = 'Insignificant')),
    n AS (SELECT risk, CASE WHEN m THEN 'Possible' ELSE likelihood END AS likelihood, CASE WHEN m AND impact = 'Catastrophic' THEN 'Major' ELSE impact END AS impact,
      CASE WHEN o_orderstatus = 'P' THEN 'Transferred' WHEN o_orderstatus = 'O' AND NOT m THEN 'Accepted' END AS response FROM r)
    SELECT *, {_score_sql()} AS score FROM n""")
def risk_responses(t):
    risks = order_risks(t.orders)
    return R.apply_responses(risks.drop("o_orderstatus"), order_responses(risks))


@query("mitigation_log", f"""
    SELECT risk, 'Diversify' AS action, '2001-12-31' AS deadline FROM ({_RISKS_SQL}) WHERE likelihood = 'Likely' AND impact = 'Catastrophic'
    UNION ALL SELECT risk, 'Consult', NULL FROM ({_RISKS_SQL}) WHERE likelihood = 'Possible' AND impact = 'Major'""")
def mitigation_log(t):
    risks = order_risks(t.orders)
    log = risks.filter("likelihood = 'Likely' AND impact = 'Catastrophic'").select(
        "risk", F.lit("Diversify").alias("action"), F.lit("2001-12-31").alias("deadline")
    )
    more = risks.filter("likelihood = 'Possible' AND impact = 'Major'").select("risk", F.lit("Consult").alias("action"))
    return R.append_mitigation(log, more)


@query("top_risks", f"SELECT risk, {_score_sql()} AS score FROM ({_RISKS_SQL}) ORDER BY score DESC, risk LIMIT 10")
def top_risks(t):
    return R.top_risks(R.risk_score(order_risks(t.orders)).select("risk", "score"), 10)


_THRESHOLDS = [("click", -0.05, 0.05), ("error", -0.05, 0.05), ("purchase", -0.5, 0.5), ("view", None, 0.1)]


@query("threshold_alerts", f"""
    WITH h(ticker, lower, upper) AS (VALUES {", ".join(f"('{k}', {'NULL' if a is None else a}::DOUBLE, {b}::DOUBLE)" for k, a, b in _THRESHOLDS)}),
    l AS ({_LATEST_SQL})
    SELECT ticker, CASE WHEN ret < lower THEN printf('%s (%.4f) is below the lower threshold (%.4f)', ticker, ret, lower)
      ELSE printf('%s (%.4f) is above the upper threshold (%.4f)', ticker, ret, upper) END AS alert
    FROM l JOIN h USING (ticker) WHERE ret < lower OR ret > upper""")
def threshold_alerts(t):
    thresholds = t.spark.createDataFrame(_THRESHOLDS, "ticker string, lower double, upper double")
    return R.threshold_alerts(latest_returns(t), thresholds, "ticker", "ret")


def score_limits(orders):
    """Upper score of an order's risk by its status; orders in progress have none."""
    upper = F.when(F.col("o_orderstatus") == "O", 12).when(F.col("o_orderstatus") == "F", 16)
    return orders.select(F.col("o_orderkey").alias("risk"), upper.alias("upper"))


@query("score_alerts", f"""
    WITH s AS (SELECT risk, {_score_sql()} AS score, CASE o_orderstatus WHEN 'O' THEN 12 WHEN 'F' THEN 16 END AS upper FROM ({_RISKS_SQL}))
    SELECT risk, printf('%d score (%d) exceeds the threshold (%d)', risk, score, upper) AS alert FROM s WHERE score > upper""")
def score_alerts(t):
    scores = R.risk_score(order_risks(t.orders)).select("risk", "score")
    return R.score_alerts(scores, score_limits(t.orders))


_UPPER_SCORE = 12


def daily_breaches(events):
    """Days on which the score of any asset, its highest value in steps of 20, passes the upper threshold."""
    score = F.floor(F.col("high") / 20)
    return daily_bars(events).groupBy("day").agg((F.max(score) > _UPPER_SCORE).alias("breached"))


def portfolio(t):
    return R.backtest(daily_returns(t.events), daily_breaches(t.events), 0.2, 0.1)


_BACKTEST_SQL = f"""SELECT day, CASE WHEN count(ret) = count(*) THEN sum(ret) * CASE WHEN max(floor(high / 20)) > {_UPPER_SCORE} THEN 0.1::DOUBLE
    ELSE 0.2::DOUBLE END END AS ret FROM ({RETURNS_SQL}) GROUP BY day"""
_BENCHMARK_SQL = f"SELECT day, avg(ret) AS ret FROM ({RETURNS_SQL}) GROUP BY day"


@query("backtest_returns", f"SELECT CAST(day AS VARCHAR) AS day, round(ret, 6) AS ret FROM ({_BACKTEST_SQL})")
def backtest_returns(t):
    return portfolio(t).select(day_text("day").alias("day"), F.round("ret", 6).alias("ret"))


@query("benchmark_returns", f"SELECT CAST(day AS VARCHAR) AS day, round(ret, 6) AS ret FROM ({_BENCHMARK_SQL})")
def benchmark_returns(t):
    return R.benchmark(daily_returns(t.events)).select(day_text("day").alias("day"), F.round("ret", 6).alias("ret"))


@query("performance_ratios", f"""
    WITH p AS (SELECT 'backtest' AS portfolio, * FROM ({_BACKTEST_SQL}) UNION ALL SELECT 'benchmark', * FROM ({_BENCHMARK_SQL})),
    v AS (SELECT *, exp(sum(ln(1 + ret)) OVER (PARTITION BY portfolio ORDER BY day)) AS v FROM p WHERE ret IS NOT NULL),
    k AS (SELECT *, greatest(max(v) OVER (PARTITION BY portfolio ORDER BY day), 1.0) AS peak FROM v)
    SELECT portfolio, round(avg(ret) / stddev_samp(ret) * sqrt(252), 4) AS sharpe,
      round(avg(ret) / sqrt(avg(pow(least(ret, 0), 2))) * sqrt(252), 4) AS sortino, round(least(min(v / peak - 1), 0), 4) AS max_drawdown
    FROM k GROUP BY 1""")
def performance_ratios(t):
    both = portfolio(t).withColumn("portfolio", F.lit("backtest")).unionByName(
        R.benchmark(daily_returns(t.events)).withColumn("portfolio", F.lit("benchmark"))
    )
    out = R.performance_ratios(both, "portfolio")
    return out.withColumns({c: F.round(c, 4) for c in ("sharpe", "sortino", "max_drawdown")})
