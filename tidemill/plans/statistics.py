"""Statistical tests over tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.tails import chi2_p, t_p
from tidemill.operators import stats
from tidemill.plans.registry import query

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM lineitem" for a in MEASURES for b in MEASURES))
def corr_matrix(t):
    return stats.corr_matrix(t.lineitem, MEASURES).withColumn("r", F.round("r", 6))


_Z = """
    WITH m AS (SELECT c_mktsegment, avg(c_acctbal) AS mu FROM customer GROUP BY 1),
    c AS (SELECT c_mktsegment, count(*)::DOUBLE AS n, avg(pow(c_acctbal - mu, 2)) AS m2, avg(pow(c_acctbal - mu, 3)) AS m3,
                 avg(pow(c_acctbal - mu, 4)) AS m4 FROM customer JOIN m USING (c_mktsegment) GROUP BY 1),
    s AS (SELECT *, m3 / pow(m2, 1.5) * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) AS y,
            -1 + sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) AS w2,
            (m4 / (m2 * m2) - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) AS x,
            6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS b FROM c),
    q AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1, 6 + 8 / b * (2 / b + sqrt(1 + 4 / (b * b))) AS a FROM s),
    z AS (SELECT *, (1 - 2 / (9 * a) - sign(1 + x * sqrt(2 / (a - 4))) * cbrt((1 - 2 / a) / abs(1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS z2 FROM q)
    SELECT c_mktsegment, round(z1 * z1 + z2 * z2, 4) AS k2, round(exp(-(z1 * z1 + z2 * z2) / 2), 6) AS p_value FROM z"""


@query("normality_k2", _Z)
def normality_k2(t):
    out = stats.normality(t.customer, "c_mktsegment", "c_acctbal")
    return out.withColumns({"k2": F.round("k2", 4), "p_value": F.round("p_value", 6)})


@query("bartlett", """
    WITH g AS (SELECT count(*) - 1 AS f, var_samp(c_acctbal) AS v FROM customer GROUP BY c_mktsegment),
    s AS (SELECT sum(f)::DOUBLE AS f, sum(f * v) AS fv, sum(f * ln(v)) AS fl, sum(1.0 / f) AS inv, count(*) AS k FROM g)
    SELECT round((f * ln(fv / f) - fl) / (1 + (inv - 1 / f) / (3 * (k - 1))), 4) AS statistic, (k - 1)::DOUBLE AS dof FROM s""")
def bartlett(t):
    return stats.bartlett(t.customer, "c_mktsegment", "c_acctbal").withColumn("statistic", F.round("statistic", 4))


@query("welch_t", """
    WITH s AS (SELECT avg(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS ma, var_samp(c_acctbal) FILTER (c_mktsegment = 'BUILDING')
        / count(*) FILTER (c_mktsegment = 'BUILDING') AS ea, count(*) FILTER (c_mktsegment = 'BUILDING') AS na,
      avg(c_acctbal) FILTER (c_mktsegment <> 'BUILDING') AS mb, var_samp(c_acctbal) FILTER (c_mktsegment <> 'BUILDING')
        / count(*) FILTER (c_mktsegment <> 'BUILDING') AS eb, count(*) FILTER (c_mktsegment <> 'BUILDING') AS nb FROM customer)
    SELECT round((ma - mb) / sqrt(ea + eb), 6) AS statistic, round(pow(ea + eb, 2) / (ea * ea / (na - 1) + eb * eb / (nb - 1)), 4) AS dof FROM s""")
def welch_t(t):
    is_builder = F.col("c_mktsegment") == "BUILDING"
    out = stats.welch(t.customer, is_builder, ~is_builder, "c_acctbal")
    return out.select(F.round("statistic", 6).alias("statistic"), F.round("dof", 4).alias("dof"))


@query("kruskal_h", """
    WITH r AS (SELECT c_mktsegment, rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2 AS rk,
                      count(*) OVER (PARTITION BY c_acctbal)::DOUBLE AS ties FROM customer),
    g AS (SELECT sum(rk) AS r, count(*)::DOUBLE AS n FROM r GROUP BY c_mktsegment),
    s AS (SELECT sum(r * r / n) AS rr, sum(n) AS n, count(*) AS k FROM g), u AS (SELECT sum(ties * ties - 1) AS ties FROM r)
    SELECT round((12 / (n * (n + 1)) * rr - 3 * (n + 1)) / (1 - ties / (n * n * n - n)), 4) AS statistic, (k - 1)::DOUBLE AS dof FROM s, u""")
def kruskal_h(t):
    return stats.kruskal(t.customer, "c_mktsegment", "c_acctbal").withColumn("statistic", F.round("statistic", 4))


@query("test_p_values")
def test_p_values(t):
    """Tail probabilities of the three tests above."""
    c = t.customer
    is_builder = F.col("c_mktsegment") == "BUILDING"
    chi = [
        s.select(F.lit(n).alias("test"), chi2_p("statistic", "dof").alias("p_value"))
        for n, s in (("bartlett", stats.bartlett(c, "c_mktsegment", "c_acctbal")), ("kruskal", stats.kruskal(c, "c_mktsegment", "c_acctbal")))
    ]
    welch = stats.welch(c, is_builder, ~is_builder, "c_acctbal").select(F.lit("welch").alias("test"), t_p("statistic", "dof").alias("p_value"))
    return chi[0].unionAll(chi[1]).unionAll(welch)


def customers_by_region(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment", "r_name", "c_acctbal")


@query("anova_two_way")
def anova_two_way(t):
    return stats.anova_two_way(customers_by_region(t), "c_mktsegment", "r_name", "c_acctbal")


@query("anova_sequential")
def anova_sequential(t):
    return stats.anova_two_way(t.orders, "o_orderpriority", "o_orderstatus", "o_totalprice", sequential=True)


# The model of both factors is fitted level by level in turns, which comes to the same sums.
_ANOVA = """
    WITH RECURSIVE t AS ({rows}), m AS (SELECT avg(y) AS mu FROM t),
    c AS (SELECT a, b, count(*)::DOUBLE AS n, sum(y - mu) AS s, sum((y - mu) * (y - mu)) AS q FROM t, m GROUP BY 1, 2),
    ca AS (SELECT a, sum(n) AS n, sum(s) AS s FROM c GROUP BY 1), cb AS (SELECT b, sum(n) AS n, sum(s) AS s FROM c GROUP BY 1),
    it(k, b, e) AS (
      SELECT 0, b, 0.0::DOUBLE FROM cb UNION ALL
      SELECT k + 1, b, (any_value(cb.s) - sum(c.n * f)) / any_value(cb.n) FROM (
        SELECT k, a, (any_value(ca.s) - sum(c.n * e)) / any_value(ca.n) AS f FROM it JOIN c USING (b) JOIN ca USING (a) WHERE k < 60 GROUP BY k, a
      ) JOIN c USING (a) JOIN cb USING (b) GROUP BY k, b),
    fa AS (SELECT a, (any_value(ca.s) - sum(c.n * e)) / any_value(ca.n) AS f FROM it JOIN c USING (b) JOIN ca USING (a) WHERE k = 60 GROUP BY a),
    x AS (SELECT (SELECT sum(f * s) FROM fa JOIN ca USING (a)) + (SELECT sum(e * s) FROM it JOIN cb USING (b) WHERE k = 60) AS both_ss,
      (SELECT sum(s * s / n) FROM ca) AS a_ss, (SELECT sum(s * s / n) FROM cb) AS b_ss, sum(s * s / n) AS c_ss, sum(q) AS q,
      (SELECT count(*) FROM ca)::DOUBLE AS la, (SELECT count(*) FROM cb)::DOUBLE AS lb, count(*)::DOUBLE AS lc, sum(n) AS n FROM c),
    r AS (SELECT '{a}' AS source, {first} AS ss, la - 1 AS dof, 1 AS o FROM x UNION ALL SELECT '{b}', both_ss - a_ss, lb - 1, 2 FROM x
      UNION ALL SELECT '{a}:{b}', c_ss - both_ss, lc - la - lb + 1, 3 FROM x UNION ALL SELECT 'residual', q - c_ss, n - lc, 4 FROM x)
    SELECT source, round(ss / (SELECT q - c_ss FROM x), 8) + 0.0 AS ratio, dof,
      CASE WHEN o < 4 THEN round(ss / dof / (SELECT (q - c_ss) / (n - lc) FROM x), 5) + 0.0 END AS f_value FROM r"""


def _variance_table(table):
    """Sums of squares as multiples of the residual one, and F values, rounded."""
    rest = table.agg(F.max(F.when(F.col("source") == "residual", F.col("sum_sq"))).alias("_rest"))
    return table.join(F.broadcast(rest)).select("source", (F.round(F.col("sum_sq") / F.col("_rest"), 8) + 0.0).alias("ratio"), "dof", (F.round("f_value", 5) + 0.0).alias("f_value"))


@query("anova_two_way_table", _ANOVA.format(
    rows="SELECT c_mktsegment AS a, r_name AS b, c_acctbal::DOUBLE AS y FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey "
    "WHERE c_mktsegment IS NOT NULL AND r_name IS NOT NULL AND c_acctbal IS NOT NULL",
    a="c_mktsegment", b="r_name", first="both_ss - b_ss"))
def anova_two_way_table(t):
    return _variance_table(anova_two_way(t))


@query("anova_sequential_table", _ANOVA.format(
    rows="SELECT o_orderpriority AS a, o_orderstatus AS b, o_totalprice::DOUBLE AS y FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL",
    a="o_orderpriority", b="o_orderstatus", first="a_ss"))
def anova_sequential_table(t):
    return _variance_table(anova_sequential(t))


@query("anova_many_levels", _ANOVA.format(
    rows="SELECT c_mktsegment AS a, n_name AS b, o_totalprice::DOUBLE AS y FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey "
    "WHERE c_mktsegment IS NOT NULL AND n_name IS NOT NULL AND o_totalprice IS NOT NULL",
    a="c_mktsegment", b="n_name", first="a_ss"))
def anova_many_levels(t):
    """Order prices by market segment and nation, solved on tables as for factors of many levels."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return _variance_table(stats.anova_two_way(rows, "c_mktsegment", "n_name", "o_totalprice", sequential=True, matrix_levels=0))


@query("standardize", """
    SELECT c_custkey, round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 6) + 0.0 AS c_acctbal
    FROM customer""")
def standardize(t):
    out = stats.standardize(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"])
    return out.withColumn("c_acctbal", F.round("c_acctbal", 6))
