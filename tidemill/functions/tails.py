"""Upper tail probabilities of the chi-square, F and t distributions, for a handful of test statistics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def chi2_tail(x: float, dof: float) -> float:
    """P(X > x) by the series of the lower incomplete gamma function."""
    if x <= 0:
        return 1.0
    a, half = dof / 2, x / 2
    if half < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-15:
            n += 1
            term *= half / n
            total += term
        return 1 - total * math.exp(-half + a * math.log(half) - math.lgamma(a))
    # continued fraction, evaluated from the far end
    fraction = 0.0
    for i in range(400, 0, -1):
        fraction = i * (i - a) / (half + 2 * i + 1 - a - fraction)
    return math.exp(-half + a * math.log(half) - math.lgamma(a)) / (half + 1 - a - fraction)


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tail = 1.0
    for m in range(400, 0, -1):
        even_term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd_term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        tail = 1 + even_term / (1 + odd_term / tail)
    first = -(a + b) * x / (a + 1)
    return front / (1 + first / tail)


def f_tail(x: float, dof1: float, dof2: float) -> float:
    return 1.0 if x <= 0 else beta_share(dof2 / 2, dof1 / 2, dof2 / (dof2 + dof1 * x))


def t_tail_two_sided(t: float, dof: float) -> float:
    return beta_share(dof / 2, 0.5, dof / (dof + t * t))


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(a, b) for a, b in zip(x, dof)])


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_tail_two_sided(a, b) for a, b in zip(t, dof)])
