"""Tail probabilities for statistics, one row per test."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def beta_fraction(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_fraction(b, a, 1.0 - x)
    scale = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = c * d
            out *= step
        if abs(step - 1.0) < 1e-15:
            break
    return scale * out / a


@pandas_udf(DoubleType())
def f_tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    """Probability that an F variable exceeds ``f``; missing where the test is undefined."""
    out = [
        beta_fraction(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * v))
        if pd.notna(v) and pd.notna(d1) and pd.notna(d2) and d1 > 0 and d2 > 0
        else np.nan
        for v, d1, d2 in zip(f, df1, df2)
    ]
    return pd.Series(out, dtype="float64").astype("object").where(lambda s: s.notna(), None)
