"""Guarded statistics as column expressions, and p-values without further libraries."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def pairs(x: str, y: str) -> Column:
    """Rows where both are there."""
    return F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1))


def safe_corr(x: str, y: str, least: int = 3) -> Column:
    """Pearson correlation of the rows where both are there; null under ``least`` rows or without spread."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)).cast("double"), F.when(both, F.col(y)).cast("double")
    spread = F.var_pop(a) * F.var_pop(b)
    varied = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when((F.count(a) >= least) & varied, F.try_divide(F.covar_pop(a, b), F.sqrt(spread)))


def t_statistic(x: str | Column, least: int = 2) -> Column:
    """One-sample t against 0; null under ``least`` values or without spread."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when((F.count(x) >= least) & (F.min(x) < F.max(x)), F.try_divide(F.avg(x), F.stddev_samp(x) / F.sqrt(F.count(x))))


def pearson_t(r: Column, n: Column) -> Column:
    return F.when(F.abs(r) < 1, r * F.sqrt((n - 2) / (1 - r * r)))


def _fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 400):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / (c if abs(c) > tiny else tiny)
            out *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return out


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1.0 - x) / b


def t_p(t: float, df: float) -> float:
    """Two-sided p-value of a t statistic."""
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_p(f: float, d1: float, d2: float) -> float:
    """Upper p-value of an F statistic."""
    return 1.0 if f <= 0 else beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_p(a, b) if not np.isnan(a) and b > 0 else None for a, b in zip(t, df)], dtype="float64")


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-value of t statistics; null stays null."""
    return F.pandas_udf(_t_p, "double")(t, df)
