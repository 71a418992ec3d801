"""Tail probabilities for test statistics.

They run on tables of one row per column, so a small vectorised helper is enough.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kolmogorov_tail(lam: float) -> float:
    if lam < 0.2:
        return 1.0
    total = sum((-1) ** (j - 1) * math.exp(-2.0 * j * j * lam * lam) for j in range(1, 101))
    return min(1.0, max(0.0, 2.0 * total))


def normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi2_tail(stat: float, dof: float) -> float:
    """Upper tail by the regularised incomplete gamma function."""
    if math.isinf(stat):
        return 0.0
    if stat <= 0 or dof <= 0:
        return 1.0
    a, x = dof / 2.0, stat / 2.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-15:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * front)
    b = x + 1 - a
    c, d = 1e300, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1.0 / ((an * d + b) or 1e-300)
        c = (b + an / c) or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, front * h)


def t_tail(t: float, dof: float) -> float:
    """Two-sided tail of Student's t by the incomplete beta function."""
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5
    if x <= 0 or x >= 1:
        return 1.0 if x >= 1 else 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x))
    if x > (a + 1) / (a + b + 2):
        return 1.0 - front * _beta_fraction(1 - x, b, a) / b
    return front * _beta_fraction(x, a, b) / a


def _beta_fraction(x: float, a: float, b: float) -> float:
    c, d = 1.0, 1.0 / ((1 - (a + b) * x / (a + 1)) or 1e-300)
    h = d
    for m in range(1, 10_000):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / ((1 + num * d) or 1e-300)
            c = (1 + num / c) or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


TAILS = {
    "ks": lambda s, p: kolmogorov_tail(s * p),  # p: sqrt(n1 * n2 / (n1 + n2))
    "chisquare": chi2_tail,
    "z": lambda s, p: normal_tail(s),
    "t_test": t_tail,
}


@F.pandas_udf(T.DoubleType())
def p_value(method: pd.Series, stat: pd.Series, parameter: pd.Series) -> pd.Series:
    return pd.Series([
        None if s is None or math.isnan(s) else TAILS[m](s, p) for m, s, p in zip(method, stat, parameter)],
        dtype="float64")
