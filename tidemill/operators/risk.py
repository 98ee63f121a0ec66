"""Portfolio-risk tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.hashing import normal_hash
from tidemill.operators.joins import bounded, product_of_dimensions
from tidemill.operators.ordering import exact_percentiles, global_running_sum

# fixed values: the two five-step scales of the qualitative assessment
LIKELIHOOD_SCALE = {"Rare": 1, "Unlikely": 2, "Possible": 3, "Likely": 4, "Almost Certain": 5}
IMPACT_SCALE = {"Insignificant": 1, "Minor": 2, "Moderate": 3, "Major": 4, "Catastrophic": 5}


def tail_risk(df: DataFrame, value: str, tail: float = 0.05) -> DataFrame:
    """Value at risk (interpolated percentile) and the mean of the ``int(n * tail)`` lowest values.

    Values collapse to counts first; running sums over the distinct values then say how many
    copies of each one belong to the tail.
    """
    rows = df.filter(F.col(value).isNotNull())
    per_value = rows.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    size = rows.agg(F.floor(F.count(F.lit(1)) * F.lit(tail)).alias("_m"))
    mark = exact_percentiles(rows, [], value, [tail]).select(F.col("marks")[0].alias("var"))
    running = global_running_sum(per_value, [value], "_c", "_upto").join(F.broadcast(size)).join(F.broadcast(mark))
    taken = F.greatest(F.least(F.col("_c"), F.col("_m") - (F.col("_upto") - F.col("_c"))), F.lit(0))
    return running.groupBy("var").agg(F.try_divide(F.sum(F.col(value) * taken), F.sum(taken)).alias("cvar"))


def latest_values(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def scenario_table(latest: DataFrame, key: str, value: str, n: int, seed: str) -> DataFrame:
    """``n`` portfolio draws: every asset normal around its last return with twice the spread across assets.

    The assets, a short list, travel as one array; the draws are what is distributed.
    """
    assets = latest.agg(
        F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("m")))).alias("_assets"),
        (2 * F.stddev_pop(value)).alias("_sd"),
    )
    draws = latest.sparkSession.range(n).withColumnRenamed("id", "draw").join(F.broadcast(assets))
    weight = 1 / F.size("_assets")

    def outcome(asset: Column) -> Column:
        return (asset["m"] + F.col("_sd") * normal_hash(seed, F.col("draw"), asset["k"])) * weight

    total = F.aggregate(F.transform("_assets", outcome), F.lit(0.0), lambda acc, v: acc + v)
    return draws.select("draw", total.alias("portfolio_return"))


def scale_lookup(scale: dict[str, int], level: Column) -> Column:
    """Step of a level on its scale; an unknown level gives null."""
    pairs = [F.lit(x) for item in scale.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), level)


def risk_score(df: DataFrame, likelihood: str = "likelihood", impact: str = "impact", out: str = "score") -> DataFrame:
    product = scale_lookup(LIKELIHOOD_SCALE, F.col(likelihood)) * scale_lookup(IMPACT_SCALE, F.col(impact))
    return df.withColumn(out, product)


def risk_matrix(risks: DataFrame) -> DataFrame:
    """All pairs of levels with their score and the number of risks found there."""
    spark = risks.sparkSession
    levels = product_of_dimensions(
        spark.createDataFrame([(k,) for k in LIKELIHOOD_SCALE], "likelihood string"),
        spark.createDataFrame([(k,) for k in IMPACT_SCALE], "impact string"),
    )
    counts = risks.groupBy("likelihood", "impact").agg(F.count(F.lit(1)).alias("n_risks"))
    joined = risk_score(levels).join(counts, ["likelihood", "impact"], "left")
    return joined.withColumn("n_risks", F.coalesce("n_risks", F.lit(0).cast("long")))


def apply_responses(risks: DataFrame, responses: DataFrame, key: str = "risk") -> DataFrame:
    """Avoided risks go, transferred and accepted ones are marked, mitigated ones take new levels and a new score."""
    r = responses.select(F.col(key).alias("_k"), "action", "new_likelihood", "new_impact")
    joined = risks.join(r, F.col(key) == F.col("_k"), "left")
    action = F.coalesce("action", F.lit("none"))
    mitigated = action == "mitigate"
    kept = joined.filter(action != "avoid").withColumns({
        "likelihood": F.when(mitigated, F.coalesce("new_likelihood", "likelihood")).otherwise(F.col("likelihood")),
        "impact": F.when(mitigated, F.coalesce("new_impact", "impact")).otherwise(F.col("impact")),
        "response": F.when(action == "transfer", "Transferred").when(action == "accept", "Accepted"),
    })
    return risk_score(kept.drop("_k", "action", "new_likelihood", "new_impact"))


def append_mitigation(log: DataFrame, rows: DataFrame) -> DataFrame:
    return log.unionByName(rows, allowMissingColumns=True)


def top_risks(df: DataFrame, n: int = 3) -> DataFrame:
    return df.orderBy(F.desc("score"), "risk").limit(n)


def threshold_alerts(df: DataFrame, thresholds: DataFrame, key: str, value: str) -> DataFrame:
    """Text for every value beyond the lower or upper threshold of its key; absent thresholds never fire."""
    joined = df.join(bounded(thresholds), key)
    v, low, high = F.col(value), F.col("lower"), F.col("upper")
    below = F.format_string("%s (%.4f) is below the lower threshold (%.4f)", F.col(key), v, low)
    above = F.format_string("%s (%.4f) is above the upper threshold (%.4f)", F.col(key), v, high)
    text = F.when(v < low, below).when(v > high, above)
    return joined.withColumn("alert", text).filter("alert IS NOT NULL").select(key, "alert")


def score_alerts(scores: DataFrame, thresholds: DataFrame, key: str = "risk", score: str = "score") -> DataFrame:
    """Text for every score above the upper threshold of its key; keys without one never fire.

    There may be as many thresholds as scores, so the join is left to adaptive execution.
    """
    limits = thresholds.filter("upper IS NOT NULL").select(F.col(key).alias("_key"), "upper")
    above = scores.join(limits, (F.col(key) == F.col("_key")) & (F.col(score) > F.col("upper")))
    text = F.format_string("%s score (%d) exceeds the threshold (%d)", F.col(key).cast("string"), F.col(score), F.col("upper"))
    return above.select(key, text.alias("alert"))


def backtest(returns: DataFrame, breaches: DataFrame, weight: float, reduced: float) -> DataFrame:
    """Portfolio return per day with reduced weights on days of a breach; a day lacking a return gives null."""
    daily = returns.groupBy("day").agg(
        F.sum("ret").alias("_sum"), (F.count("ret") == F.count(F.lit(1))).alias("_complete")
    )
    flagged = daily.join(breaches, "day", "left")
    used = F.when(F.coalesce("breached", F.lit(False)), F.lit(reduced)).otherwise(F.lit(weight))
    return flagged.select("day", F.when(F.col("_complete"), F.col("_sum") * used).alias("ret"))


def benchmark(returns: DataFrame) -> DataFrame:
    return returns.groupBy("day").agg(F.avg("ret").alias("ret"))


def performance_ratios(daily: DataFrame, key: str, periods: int = 252) -> DataFrame:
    """Sharpe, Sortino and maximum drawdown per portfolio of a (key, day, ret) table; missing returns are skipped."""
    rows = daily.filter(F.col("ret").isNotNull())
    window = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    valued = rows.withColumn("_v", F.exp(F.sum(F.log1p("ret")).over(window)))
    peaked = valued.withColumn("_peak", F.greatest(F.max("_v").over(window), F.lit(1.0)))
    downside = F.sqrt(F.avg(F.pow(F.least("ret", F.lit(0.0)), 2)))
    return peaked.groupBy(key).agg(
        (F.try_divide(F.avg("ret"), F.stddev_samp("ret")) * F.sqrt(F.lit(periods))).alias("sharpe"),
        (F.try_divide(F.avg("ret"), downside) * F.sqrt(F.lit(periods))).alias("sortino"),
        F.least(F.min(F.col("_v") / F.col("_peak") - 1), F.lit(0.0)).alias("max_drawdown"),
    )
