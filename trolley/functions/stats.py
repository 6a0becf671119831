"""Small statistical helpers.

* ``t_quantile``   Student-t quantile for one driver-side scalar (df from a count);
                   bisection on the regularised incomplete beta function.
* ``chi2_pvalue``  vectorised (Arrow) p-value of a 1-df chi-square statistic.
* ``chi2_critical`` critical value of a 1-df chi-square at level alpha (= z^2).
"""

from __future__ import annotations

import math
from statistics import NormalDist

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _betacf(a: float, b: float, x: float) -> float:
    # continued fraction for the incomplete beta function (modified Lentz)
    tiny, eps = 1e-300, 1e-15
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def _betainc(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log(1.0 - x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_cdf(t: float, df: float) -> float:
    x = df / (df + t * t)
    tail = 0.5 * _betainc(df / 2.0, 0.5, x)
    return 1.0 - tail if t > 0 else tail


def t_quantile(p: float, df: float) -> float:
    if df <= 0:
        return float("nan")
    if df > 1e7:
        return NormalDist().inv_cdf(p)
    lo, hi = -1e3, 1e3
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if t_cdf(mid, df) < p:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def chi2_critical(alpha: float) -> float:
    z = NormalDist().inv_cdf(1.0 - alpha / 2.0)
    return z * z


@F.pandas_udf(T.DoubleType())
def chi2_pvalue(stat: pd.Series) -> pd.Series:
    """P(X > stat) for X ~ chi-square(1) = erfc(sqrt(stat / 2))."""
    return stat.map(lambda s: math.erfc(math.sqrt(s / 2.0)) if s == s and s >= 0 else float("nan"))
