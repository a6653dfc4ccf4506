"""Tail probabilities of the test statistics, without scipy.

Statistics come out of Spark aggregates with one row per feature; the tail
probability is a small per-row helper applied as an Arrow-batched pandas UDF
(``*_udf``) so results stay lazy DataFrames.  The regularised incomplete beta
and gamma functions are continued fractions, evaluated from a tail that is
moved out until it no longer matters, and a series.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Terms tried at most; the fractions below need far fewer unless the parameters are huge.
MOST_TERMS = 1 << 18


def _fraction(numerator, denominator) -> float:
    """denominator(0) + numerator(1) / (denominator(1) + numerator(2) / (...)), from its tail upwards.

    The tail is cut off at twice as many terms until the value stays the same."""
    terms, before = 32, math.nan
    while terms <= MOST_TERMS:
        value = denominator(terms)
        for j in range(terms, 0, -1):
            value = denominator(j - 1) + numerator(j) / (value or 1e-300)
        if abs(value - before) <= 1e-15 * abs(value):
            break
        terms, before = 2 * terms, value
    return value


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x * (a + b + 2.0) >= a + 1.0:  # the fraction converges fast below the mean only
        return 1.0 - betainc(b, a, 1.0 - x) if (1.0 - x) * (a + b + 2.0) < b + 1.0 else 1.0 - _beta_part(b, a, 1.0 - x)
    return _beta_part(a, b, x)


def _beta_part(a: float, b: float, x: float) -> float:
    """x^a (1 - x)^b / (a B(a, b)) over the fraction 1 + c1 / (1 + c2 / (1 + ...))."""
    def c(j: int) -> float:
        m = j // 2
        if j % 2:
            return -(a + m) * (a + b + m) * x / ((a + j - 1) * (a + j))
        return m * (b - m) * x / ((a + j - 1) * (a + j))
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(scale) / (a * _fraction(c, lambda j: 1.0))


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1.0:  # the lower part as the series of x^n / (a (a + 1) ... (a + n))
        term = total = 1.0 / a
        n = 0
        while term > 1e-17 * total:
            n += 1
            term *= x / (a + n)
            total += term
        return max(0.0, 1.0 - scale * total)
    return scale / _fraction(lambda j: -j * (j - a), lambda j: x + 1.0 - a + 2 * j)


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or not np.isfinite(df) or df <= 0 or math.isnan(t):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_upper(x: float, df: float) -> float:
    if x is None or math.isnan(x) or df <= 0:
        return float("nan")
    return gammaincc(df / 2.0, x / 2.0)


def norm_two_sided(z: float) -> float:
    if z is None or math.isnan(z):
        return float("nan")
    return math.erfc(abs(z) / math.sqrt(2.0))


def _vec(fn, *cols: pd.Series) -> pd.Series:
    out = [fn(*[None if (v is None or (isinstance(v, float) and math.isnan(v))) else float(v) for v in vals])
           if all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in vals) else None
           for vals in zip(*cols)]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def f_pvalue_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_upper, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def chi2_pvalue_udf(x: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(chi2_upper, x, df)
