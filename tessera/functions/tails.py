"""Tail probabilities of the t and F distributions (scipy is not available).

The regularised incomplete beta function is evaluated by its continued
fraction (DLMF 8.17.22), from the inside out. These run only on result
rows -- one per group or coefficient -- inside an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _fraction(a: float, b: float, x: float, terms: int) -> float:
    """1 / (1 + d1 / (1 + d2 / (1 + ...))) cut after ``terms`` coefficients:
    d(2m) = m (b - m) x / ((a + 2m - 1)(a + 2m)),
    d(2m + 1) = -(a + m)(a + b + m) x / ((a + 2m)(a + 2m + 1))."""
    value = 1.0
    for n in range(terms, 0, -1):
        m, odd = divmod(n, 2)
        if odd:
            d = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            d = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        value = 1.0 + d / value
    return 1.0 / value


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The fraction to double precision: twice as many terms until it settles."""
    terms, last = 32, math.nan
    while terms <= 1 << 20:
        value = _fraction(a, b, x, terms)
        if abs(value - last) <= 1e-15 * abs(value):
            break
        terms, last = 2 * terms, value
    return value


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(lbt) * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or df <= 0 or math.isnan(t) or math.isnan(df):
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    """P(F >= f) for the F distribution with (d1, d2) degrees of freedom."""
    if f is None or d1 <= 0 or d2 <= 0 or math.isnan(f):
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@F.pandas_udf(DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if (pd.isna(a) or pd.isna(b)) else t_two_sided(float(a), float(b))
                      for a, b in zip(t, df)], dtype="float64")


def _ship() -> None:
    from pyspark.sql import SparkSession

    from tessera.session import ship_package

    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)


def t_pvalue(t: Column, df: Column) -> Column:
    """Two-sided p of a t statistic, for result rows (one per group)."""
    _ship()
    return _t_p_udf(t.cast("double"), df.cast("double"))
