"""Tail probabilities of F, t and the studentized range, vectorised with numpy.

They run on test results, one row per test, never on measurements.
"""

from __future__ import annotations

from math import erfc, lgamma

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_log_gamma = np.vectorize(lgamma, otypes=[float])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, terms: int = 500) -> np.ndarray:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    total = d.copy()
    for m in range(1, terms + 1):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            total = total * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return total


def incomplete_beta(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
                       + a * np.log(x) + b * np.log1p(-x))
        swap = x > (a + 1.0) / (a + b + 2.0)
        p, q, z = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
        value = front * _beta_fraction(p, q, z) / p
    value = np.where(swap, 1.0 - value, value)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, value))


def f_tail(f, df1, df2) -> np.ndarray:
    """P(F > f)."""
    f, df1, df2 = (np.asarray(v, dtype=float) for v in (f, df1, df2))
    safe = np.where(f > 0, f, 0.0)
    return incomplete_beta(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * safe))


def t_tail(t, df) -> np.ndarray:
    """P(|T| > |t|)."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


# The normal distribution function: a table on a grid, and from its nearest point a Taylor step of four terms.
_STEP, _REACH = 1.0 / 64, 9.0
_GRID = np.arange(-_REACH, _REACH + _STEP / 2, _STEP)
_GRID_CDF = np.array([0.5 * erfc(-z / np.sqrt(2.0)) for z in _GRID])


def _normal_cdf(z: np.ndarray) -> np.ndarray:
    """P(Z <= z) for all of ``z`` at once, to about 1e-13."""
    at = np.clip(np.rint((z + _REACH) / _STEP), 0, len(_GRID) - 1).astype(int)
    x, d = _GRID[at], np.clip(z, -_REACH, _REACH) - _GRID[at]
    terms = 1 + d * (-x / 2 + d * ((x * x - 1) / 6 + d * (x * (3 - x * x) / 24 + d * (x ** 4 - 6 * x * x + 3) / 120)))
    return np.clip(_GRID_CDF[at] + np.exp(-0.5 * x * x) / np.sqrt(2.0 * np.pi) * d * terms, 0.0, 1.0)


_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(64)
# Rows computed together: each holds a 64 by 64 table of doubles.
_ROWS = 256


def _range_cdf(w: np.ndarray, k: np.ndarray) -> np.ndarray:
    """P(range of k standard normals <= w), for rows of ``w`` (rows, nodes) and one k a row."""
    z = 8.0 * _NODES                      # the density is negligible beyond |z| = 8
    density = 8.0 * _WEIGHTS * np.exp(-0.5 * z * z) / np.sqrt(2.0 * np.pi)
    gap = np.clip(_normal_cdf(z + w[:, :, None]) - _normal_cdf(z), 0.0, 1.0)
    return np.clip(k[:, None] * np.sum(density * gap ** (k[:, None, None] - 1.0), axis=2), 0.0, 1.0)


def studentized_range_tail(q, k, df) -> np.ndarray:
    """P(Q > q) for k groups and df degrees of freedom, a row each; 1 where q is not positive."""
    q, k, df = (np.atleast_1d(np.asarray(v, dtype=float)) for v in np.broadcast_arrays(q, k, df))
    out = np.ones(len(q))
    rows = np.flatnonzero(q > 0)
    for begin in range(0, len(rows), _ROWS):
        at = rows[begin:begin + _ROWS]
        d = df[at, None]
        spread = 1.0 / np.sqrt(2.0 * d)
        low, high = np.maximum(1e-8, 1.0 - 8.0 * spread), 1.0 + 8.0 * spread
        s = 0.5 * (high - low) * _NODES + 0.5 * (high + low)
        # The density of the estimated deviation up to a factor, which the division below takes out.
        mass = _WEIGHTS * np.exp((d - 1.0) * np.log(s) - d * (s * s - 1.0) / 2.0)
        inside = np.sum(mass * _range_cdf(q[at, None] * s, k[at]), axis=1) / np.sum(mass, axis=1)
        out[at] = np.clip(1.0 - inside, 0.0, 1.0)
    return out


@F.pandas_udf(DoubleType())
def f_p_value(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series(f_tail(f, df1, df2)).where(f.notna().to_numpy())


@F.pandas_udf(DoubleType())
def t_p_value(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_tail(t, df)).where(t.notna().to_numpy())


@F.pandas_udf(DoubleType())
def tukey_p_value(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(studentized_range_tail(q.fillna(0.0), k, df)).where(q.notna().to_numpy())
