"""Statistical tests computed from grouped aggregates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.tails import f_tail
from tidemill.operators.ordering import global_running_sum
from tidemill.session import stage


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, each over its complete pairs, from one aggregate."""
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r")) for a in columns for b in columns
    ]
    return df.agg(F.array(*pairs).alias("pairs")).select(F.explode("pairs").alias("p")).select("p.*")


def skew_z(n: Column, skew: Column) -> Column:
    """Normal score of a sample skewness (D'Agostino 1970)."""
    scaled = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    spread = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2 * (spread - 1)) - 1
    ratio = scaled / F.sqrt(2 / (w2 - 1))
    return F.log(ratio + F.sqrt(ratio * ratio + 1)) / F.sqrt(F.log(w2) / 2)


def kurtosis_z(n: Column, excess: Column) -> Column:
    """Normal score of a sample kurtosis (Anscombe and Glynn 1983)."""
    mean = 3 * (n - 1) / (n + 1)
    variance = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (excess + 3 - mean) / F.sqrt(variance)
    moment = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / moment * (2 / moment + F.sqrt(1 + 4 / (moment * moment)))
    base = 1 + x * F.sqrt(2 / (a - 4))
    root = F.signum(base) * F.cbrt((1 - 2 / a) / F.abs(base))
    return (1 - 2 / (9 * a) - root) / F.sqrt(2 / (9 * a))


def normality(df: DataFrame, group: str, value: str) -> DataFrame:
    """D'Agostino-Pearson K2 per group; its tail under two degrees of freedom is exp(-K2 / 2)."""
    moments = df.groupBy(group).agg(
        F.count(value).cast("double").alias("n"), F.skewness(value).alias("skew"), F.kurtosis(value).alias("excess")
    )
    n = F.col("n")
    k2 = F.pow(skew_z(n, F.col("skew")), 2) + F.pow(kurtosis_z(n, F.col("excess")), 2)
    return moments.select(group, k2.alias("k2")).withColumn("p_value", F.exp(-F.col("k2") / 2))


def bartlett(df: DataFrame, group: str, value: str) -> DataFrame:
    """Bartlett's statistic for equal variances, with its degrees of freedom."""
    per_group = df.groupBy(group).agg((F.count(value) - 1).cast("double").alias("f"), F.var_samp(value).alias("v"))
    sums = per_group.agg(
        F.sum("f").alias("f"), F.sum(F.col("f") * F.col("v")).alias("fv"), F.sum(F.col("f") * F.log("v")).alias("flogv"),
        F.sum(1 / F.col("f")).alias("inv"), F.count(F.lit(1)).cast("double").alias("k"),
    )
    top = F.col("f") * F.log(F.col("fv") / F.col("f")) - F.col("flogv")
    correction = 1 + (F.col("inv") - 1 / F.col("f")) / (3 * (F.col("k") - 1))
    return sums.select((top / correction).alias("statistic"), (F.col("k") - 1).alias("dof"))


def welch(df: DataFrame, first: Column, second: Column, value: str) -> DataFrame:
    """Welch's t for two groups given as conditions, with the Welch-Satterthwaite degrees of freedom."""

    def part(c: Column, tag: str) -> list[Column]:
        v = F.when(c, F.col(value))
        return [F.avg(v).alias(f"m{tag}"), F.var_samp(v).alias(f"v{tag}"), F.count(v).alias(f"n{tag}")]

    s = df.agg(*part(first, "a"), *part(second, "b"))
    ea, eb = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
    dof = F.try_divide(F.pow(ea + eb, 2), F.try_divide(ea * ea, F.col("na") - 1) + F.try_divide(eb * eb, F.col("nb") - 1))
    return s.select(F.try_divide(F.col("ma") - F.col("mb"), F.sqrt(ea + eb)).alias("statistic"), dof.alias("dof"))


def kruskal(df: DataFrame, group: str, value: str) -> DataFrame:
    """Kruskal-Wallis H with tie correction.

    Rows collapse to counts per distinct value first; average ranks follow from a running
    sum of those counts, so neither ties nor the table size end up in one task.
    """
    per_pair = df.filter(F.col(value).isNotNull()).groupBy(value, group).agg(F.count(F.lit(1)).alias("_c"))
    per_value = per_pair.groupBy(value).agg(F.sum("_c").alias("_t"))
    ranked = global_running_sum(per_value, [value], "_t", "_upto").select(
        value, (F.col("_upto") - F.col("_t") + (F.col("_t") + 1) / 2).alias("_rank")
    )
    per_group = per_pair.join(ranked, value).groupBy(group).agg(
        F.sum(F.col("_c") * F.col("_rank")).alias("_r"), F.sum("_c").cast("double").alias("_n")
    )
    sums = per_group.agg(
        F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("rr"), F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k")
    )
    t = F.col("_t").cast("double")
    ties = per_value.agg(F.sum(t * t * t - t).alias("ties"))
    n = F.col("n")
    h = (12 / (n * (n + 1)) * F.col("rr") - 3 * (n + 1)) / (1 - F.col("ties") / (n * n * n - n))
    return sums.join(F.broadcast(ties)).select(h.alias("statistic"), (F.col("k") - 1).cast("double").alias("dof"))


_ANOVA_SCHEMA = "source string, sum_sq double, dof double, f_value double, p_value double"
#: Levels of the smaller factor up to which its equations are solved as a matrix; beyond, by conjugate gradients on tables.
MATRIX_LEVELS = 64
TOLERANCE = 1e-20


def _reduced_by_matrix(cells: DataFrame, per_big: DataFrame, per_small: DataFrame) -> DataFrame:
    """What the small factor explains beyond the big one (one row): the levels of the big factor are eliminated in Spark,
    since their block is diagonal, and a matrix of small levels by small levels is left."""
    shares = cells.join(per_big.select("big", F.col("n").alias("nb"), F.col("s").alias("sb")), "big")
    one, two = (shares.select("big", "nb", F.col("small").alias(c), F.col("n").alias(f"n_{c}")) for c in ("i", "j"))
    minus = one.join(two.drop("nb"), "big").groupBy("i", "j").agg((-F.sum(F.col("n_i") * F.col("n_j") / F.col("nb"))).alias("v"))
    right = shares.groupBy("small").agg(F.sum(F.col("n") * F.col("sb") / F.col("nb")).alias("v"))
    diagonal = per_small.select(F.col("small").alias("i"), F.col("small").alias("j"), F.col("n").alias("v"))
    target = per_small.join(right, "small").select(F.col("small").alias("i"), F.lit(None).cast("string").alias("j"), (F.col("s") - F.col("v")).alias("v"))
    entries = minus.unionAll(diagonal).unionAll(target)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        levels = np.unique(pdf["i"])
        at = np.searchsorted(levels, pdf["i"])
        whole = pdf["j"].notna().to_numpy()
        gram, r = np.zeros((len(levels), len(levels))), np.zeros(len(levels))
        np.add.at(gram, (at[whole], np.searchsorted(levels, pdf["j"][whole])), pdf["v"][whole])
        np.add.at(r, at[~whole], pdf["v"][~whole])
        return pd.DataFrame({"extra": [float(r @ np.linalg.lstsq(gram, r, rcond=1e-10)[0])]})

    return entries.groupBy(F.lit(0).alias("_all")).applyInPandas(solve, "extra double")


def _reduced_by_gradients(cells: DataFrame, per_big: DataFrame, per_small: DataFrame) -> DataFrame:
    """The same for any number of levels: conjugate gradients whose vectors are tables, a step for two joins and sums."""
    counts_big, counts_small = per_big.select("big", F.col("n").alias("nb")), per_small.select("small", F.col("n").alias("ns"))

    def reduced(column: str, table: DataFrame) -> DataFrame:
        """The equations left after elimination, times a vector (small, ``column``)."""
        up = cells.join(table, "small").groupBy("big").agg(F.sum(F.col("n") * F.col(column)).alias("_u")).join(counts_big, "big")
        back = cells.join(up.select("big", (F.col("_u") / F.col("nb")).alias("_u")), "big").groupBy("small").agg(F.sum(F.col("n") * F.col("_u")).alias("_b"))
        return table.join(back, "small").join(counts_small, "small").withColumn("_sp", F.col("ns") * F.col(column) - F.col("_b")).drop("_b", "ns")

    explained = cells.join(per_big.select("big", (F.col("s") / F.col("n")).alias("_m")), "big").groupBy("small").agg(F.sum(F.col("n") * F.col("_m")).alias("_e"))
    start = per_small.join(explained, "small").select("small", (F.col("s") - F.col("_e")).alias("t"))
    state = stage(start.select("small", "t", F.lit(0.0).alias("x"), F.col("t").alias("r"), F.col("t").alias("p")), "gradient")
    first = size = state.agg(F.sum(F.col("r") * F.col("r"))).first()[0] or 0.0
    # Exact after as many steps as there are levels but for rounding.
    for _ in range(state.count() + 16):
        if size <= TOLERANCE * first:
            break
        moved = stage(reduced("p", state), "gradient")
        curve = moved.agg(F.sum(F.col("p") * F.col("_sp"))).first()[0]
        if not curve or curve <= 0:
            break
        step = size / curve
        following = moved.select("small", "t", (F.col("x") + step * F.col("p")).alias("x"), (F.col("r") - step * F.col("_sp")).alias("r"), "p")
        after = following.agg(F.sum(F.col("r") * F.col("r"))).first()[0]
        state = stage(following.withColumn("p", F.col("r") + (after / size) * F.col("p")), "gradient")
        size = after
    return state.agg(F.sum(F.col("t") * F.col("x")).alias("extra"))


def anova_two_way(df: DataFrame, a: str, b: str, y: str, sequential: bool = False, matrix_levels: int = MATRIX_LEVELS) -> DataFrame:
    """Two-way analysis of variance with interaction, type II or sequential sums of squares.

    Spark reduces the table to sums per pair of levels. One-factor and full models need no more than their sums of
    squares; for both factors without interaction the one with more levels is eliminated by its diagonal block, and
    the other's equations are solved as a small matrix or, for many levels, by conjugate gradients on tables, so any
    number of levels and pairs will do. Rows with a null value or level are left out.
    """
    rows = df.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"), F.col(y).cast("double").alias("y")).dropna()
    mean = F.broadcast(rows.agg(F.avg("y").alias("_mean")))
    centred = rows.join(mean).withColumn("y", F.col("y") - F.col("_mean"))
    cells = stage(centred.groupBy("a", "b").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q")), "cells")
    per = {c: stage(cells.groupBy(c).agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "levels") for c in ("a", "b")}
    levels = {c: d.count() for c, d in per.items()}
    small, big = ("a", "b") if levels["a"] <= levels["b"] else ("b", "a")
    named = cells.select(F.col(big).alias("big"), F.col(small).alias("small"), "n", "s")
    per_big, per_small = per[big].withColumnRenamed(big, "big"), per[small].withColumnRenamed(small, "small")
    reduce_by = _reduced_by_matrix if levels[small] <= matrix_levels else _reduced_by_gradients
    square = lambda d, out: d.agg(F.sum(F.col("s") * F.col("s") / F.col("n")).alias(out))
    sums = cells.agg(F.sum("q").alias("q"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("cells"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("full"))
    figures = sums.join(square(per["a"], "only_a")).join(square(per["b"], "only_b")).join(reduce_by(named, per_big, per_small))

    def table(frames):
        for pdf in frames:
            for one in pdf.to_dict("records"):
                both = one[f"only_{big}"] + (one["extra"] or 0.0)
                ss = np.array([one["only_a"] if sequential else both - one["only_b"], both - one["only_a"], one["full"] - both, one["q"] - one["full"]])
                dof = np.array([levels["a"] - 1, levels["b"] - 1, one["cells"] - levels["a"] - levels["b"] + 1, one["n"] - one["cells"]], float)
                with np.errstate(divide="ignore", invalid="ignore"):
                    f = ss[:3] / dof[:3] / (ss[3] / dof[3])
                p = [f_tail(v, d, dof[3]) if np.isfinite(v) else None for v, d in zip(f, dof)]
                yield pd.DataFrame({
                    "source": [a, b, f"{a}:{b}", "residual"], "sum_sq": ss, "dof": dof, "f_value": [*[v if np.isfinite(v) else None for v in f], None], "p_value": [*p, None],
                })

    return figures.filter("n IS NOT NULL").mapInPandas(table, _ANOVA_SCHEMA)


def standardize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns shifted to mean zero and scaled by their population standard deviation."""
    moments = df.agg(*[e for c in columns for e in (F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])
    scaled = {c: F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in columns}
    return df.join(F.broadcast(moments)).withColumns(scaled).select(*df.columns)


