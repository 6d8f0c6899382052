"""Test statistics and their p-values."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Where the series of the error function gives way to the continued fraction of its complement, and the terms of each.
TURN, TERMS, STEPS = 2.0, 45, 120


def log_erfc(x: Column) -> Column:
    """Logarithm of the complementary error function of a non-negative column, at any size of ``x``.

    Up to ``TURN`` it comes from the series of erf in powers of 2 x^2, beyond from the continued fraction of erfc, whose leading
    factor exp(-x^2) becomes a summand; so nothing underflows. Both are to about 14 digits.
    """
    square = F.lit(2.0) * x * x
    series = F.lit(1.0)
    for n in range(TERMS, 0, -1):
        series = F.lit(1.0) + square / F.lit(2.0 * n + 1.0) * series
    erf = F.lit(2.0 / math.sqrt(math.pi)) * x * F.exp(-x * x) * series
    # The fraction from its end; the value there is the fixed point that its steps draw near to.
    steps = F.sequence(F.lit(STEPS), F.lit(1), F.lit(-1))
    below = F.aggregate(steps, (x + F.sqrt(x * x + F.lit(2.0 * STEPS))) / 2, lambda value, n: x + n / (F.lit(2.0) * value))
    return F.when(x <= TURN, F.log(F.lit(1.0) - erf)).otherwise(-x * x - F.log(F.lit(math.sqrt(math.pi)) * below))


def erfc(x: Column) -> Column:
    """Complementary error function of a non-negative column."""
    return F.exp(log_erfc(x))


def two_proportion_z(x1: Column, n1: Column, x2: Column, n2: Column) -> Column:
    """Pooled z of x1/n1 against x2/n2; NULL where the pooled rate is 0 or 1."""
    rate = F.try_divide((x1 + x2).cast("double"), (n1 + n2).cast("double"))
    spread = F.sqrt(rate * (F.lit(1.0) - rate) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    gap = F.try_divide(x1.cast("double"), n1) - F.try_divide(x2.cast("double"), n2)
    return F.try_divide(gap, spread)


def log_normal_two_sided(z: Column) -> Column:
    """Logarithm of the two-sided p-value of a normal variable; it tells apart values whose p-values are all zero."""
    return log_erfc(F.abs(z) / F.lit(math.sqrt(2.0)))


def normal_two_sided(z: Column) -> Column:
    return F.exp(log_normal_two_sided(z))


def welch_t(m1: Column, v1: Column, n1: Column, m2: Column, v2: Column, n2: Column) -> Column:
    return F.try_divide(m1 - m2, F.sqrt(F.try_divide(v1, n1) + F.try_divide(v2, n2)))


def welch_df(v1: Column, n1: Column, v2: Column, n2: Column) -> Column:
    a, b = F.try_divide(v1, n1), F.try_divide(v2, n2)
    return F.try_divide((a + b) * (a + b), F.try_divide(a * a, n1 - 1) + F.try_divide(b * b, n2 - 1))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function by Lentz's method."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + step / np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


def log_student_two_sided_array(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Logarithm of P(|T| > |t|) for Student's distribution; NaN where an argument is NaN."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    out = np.full(t.shape, np.nan)
    ok = np.isfinite(t) & np.isfinite(df) & (df > 0)
    if not ok.any():
        return out
    a, b = df[ok] / 2.0, np.full(ok.sum(), 0.5)
    x = df[ok] / (df[ok] + t[ok] ** 2)
    log_beta = np.array([math.lgamma(p + 0.5) - math.lgamma(p) - math.lgamma(0.5) for p in a])
    with np.errstate(divide="ignore", invalid="ignore"):
        # log(x) and log(1 - x) lose all digits when one of them is near 1, so they are taken from t itself.
        log_x = -np.log1p(t[ok] ** 2 / df[ok])
        log_rest = np.log(t[ok] ** 2 / (df[ok] + t[ok] ** 2))
        log_front = log_beta + a * log_x + b * log_rest
        low = x < (a + 1.0) / (a + b + 2.0)
        # Far out the fraction stands beside a factor that would underflow, so their logarithms are added.
        direct = log_front + np.log(_beta_fraction(a, b, x) / a)
        mirrored = np.log1p(-np.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b)
    out[ok] = np.where(t[ok] == 0.0, 0.0, np.where(low, direct, mirrored))
    return out


def student_two_sided_array(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) for Student's distribution; NaN where an argument is NaN."""
    return np.exp(log_student_two_sided_array(t, df))


@F.pandas_udf(DoubleType())
def log_student_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    """Logarithm of the two-sided p-value of Student's t, NULL where t or df is NULL."""
    p = log_student_two_sided_array(t.to_numpy(float, na_value=np.nan), df.to_numpy(float, na_value=np.nan))
    return pd.Series(p).astype(object).where(~np.isnan(p), None).astype("Float64")


def student_two_sided(t: Column | str, df: Column | str) -> Column:
    return F.exp(log_student_two_sided(t, df))
