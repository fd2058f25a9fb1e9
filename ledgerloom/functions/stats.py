"""Tail probabilities of the t and F distributions, for columns of already aggregated figures.

Spark has no such function. The argument columns hold one row per fitted model, so the Python side stays tiny.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if not 0.0 < x < 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    front = math.exp(
        a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    )
    tiny = 1e-300
    f, c, d = 1.0, 1.0, 0.0
    for i in range(500):
        m = i // 2
        if i == 0:
            step = 1.0
        elif i % 2 == 0:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / (1.0 + step * d or tiny)
        c = 1.0 + step / c or tiny
        f *= c * d
        if abs(1.0 - c * d) < 1e-15:
            break
    return front * (f - 1.0) / a


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > |t|)."""
    if math.isinf(t):
        return 0.0
    return beta_inc(dof / 2.0, 0.5, dof / (dof + t * t))


def t_quantile(p: float, dof: float) -> float:
    """Upper quantile for 0.5 < p < 1, by bisection on the tail."""
    tail, low, high = 2.0 * (1.0 - p), 0.0, 2.0
    while t_two_sided(high, dof) > tail:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_two_sided(mid, dof) > tail else (low, mid)
    return (low + high) / 2.0


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    if math.isinf(f):
        return 0.0
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def pearson(a: Column, b: Column) -> Column:
    """Aggregate: correlation over the rows where both are present, NULL for a constant side.

    (`corr` raises a division by zero on a constant column in ANSI mode.)
    """
    x, y = F.when(b.isNotNull(), a.cast("double")), F.when(a.isNotNull(), b.cast("double"))
    return F.try_divide(F.covar_pop(x, y), F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0)))


def _missing(*values) -> bool:
    return any(v is None or v != v for v in values)


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if _missing(a, n) or n <= 0 else t_two_sided(a, n) for a, n in zip(t, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def t_critical_95(dof: pd.Series) -> pd.Series:
    cache: dict[float, float] = {}
    out = []
    for n in dof:
        if _missing(n) or n <= 0:
            out.append(None)
            continue
        if n not in cache:
            cache[n] = t_quantile(0.975, n)
        out.append(cache[n])
    return pd.Series(out, dtype="float64")


@F.pandas_udf(DoubleType())
def f_pvalue(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(
        [None if _missing(a, m, n) or n <= 0 else f_tail(a, m, n) for a, m, n in zip(f, d1, d2)], dtype="float64"
    )
