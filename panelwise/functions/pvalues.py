"""Two-sided p-values as Arrow UDFs; Spark has no distribution functions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_lgamma = np.vectorize(math.lgamma, otypes=[float])


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function, by Lentz's continued fraction on the side where it converges fast."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(y) + q * np.log1p(-y)) / p
        tiny = 1e-300
        c, d = np.ones_like(y), 1 / np.where((v := 1 - (p + q) * y / (p + 1)) == 0, tiny, v)
        h = d.copy()
        for m in range(1, 300):
            even = m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m))
            odd = -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))
            for term in (even, odd):
                d = 1 / np.where((v := 1 + term * d) == 0, tiny, v)
                c = np.where((v := 1 + term / c) == 0, tiny, v)
                h = h * d * c
    out = front * h
    out = np.where(y <= 0, 0.0, out)
    return np.where(swap, 1 - out, out)


@F.pandas_udf(DoubleType())
def p_value_t(t: pd.Series, df: pd.Series) -> pd.Series:
    ok = t.notna() & df.notna() & (df > 0)
    tt, dd = t.where(ok, 0.0).to_numpy(float), df.where(ok, 1).to_numpy(float)
    return pd.Series(np.where(ok, incomplete_beta(dd / 2, np.full_like(dd, 0.5), dd / (dd + tt**2)), np.nan)).where(ok.to_numpy(), None)


def p_value_norm(z: Column | str) -> Column:
    """2 (1 - N(|z|)), which is the chi-square tail of z * z with one degree."""
    z = F.col(z) if isinstance(z, str) else z
    return p_value_chi2(z * z, F.lit(1.0))


@F.pandas_udf(DoubleType())
def p_value_f(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    ok = f.notna() & (f >= 0)
    x, a, b = f.where(ok, 0.0).to_numpy(float), d1.to_numpy(float), d2.to_numpy(float)
    return pd.Series(incomplete_beta(b / 2, a / 2, b / (b + a * x))).where(ok.to_numpy(), None)


def upper_gamma(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma function: a series below a + 1, Lentz's continued fraction from there."""
    a, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, x))
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        front = np.exp(a * np.log(x) - x - _lgamma(a))
        low = np.minimum(x, a + 1)
        term = total = 1 / a
        for k in range(1, 400):
            term = term * low / (a + k)
            total = total + term
        high = np.maximum(x, a + 1)
        b = high + 1 - a
        c, d = np.full_like(b, 1e300), 1 / b
        h = d
        for k in range(1, 400):
            step = -k * (k - a)
            b = b + 2
            d = 1 / np.where((v := step * d + b) == 0, 1e-300, v)
            c = np.where((v := b + step / c) == 0, 1e-300, v)
            h = h * d * c
    return np.where(x <= 0, 1.0, np.where(x < a + 1, 1 - front * total, front * h))


@F.pandas_udf(DoubleType())
def p_value_chi2(x: pd.Series, df: pd.Series) -> pd.Series:
    ok = x.notna() & df.notna() & (x >= 0) & (df > 0)
    return pd.Series(upper_gamma(df.where(ok, 1.0).to_numpy(float) / 2, x.where(ok, 0.0).to_numpy(float) / 2)).where(ok.to_numpy(), None)
