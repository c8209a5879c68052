"""Tail probabilities for the small result tables of the statistics operators.

Vectorised over numpy arrays: series and continued fractions of the regularised incomplete
beta and gamma functions.
"""

from __future__ import annotations

import math

import numpy as np

_STEPS = 400
_TINY = 1e-300


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Made anew each time: a vectorised function that has run cannot be shipped to tasks."""
    return np.vectorize(math.lgamma, otypes=[float])(x)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of I_x(a, b) by the modified Lentz method."""

    def guard(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) < _TINY, _TINY, v)

    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    h = d.copy()
    for m in range(1, _STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / guard(1.0 + term * d)
            c = guard(1.0 + term / c)
            h = h * c * d
    return h


def beta_inc(a, b, x) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.asarray(x, float))
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    inside = (y > 0) & (y < 1)
    safe = np.where(inside, y, 0.5)
    front = np.exp(_lgamma(p + q) - _lgamma(p) - _lgamma(q) + p * np.log(safe) + q * np.log1p(-safe)) / p
    value = np.where(inside, front * _beta_fraction(p, q, safe), np.where(y <= 0, 0.0, 1.0))
    return np.where(np.isnan(x), np.nan, np.where(swap, 1.0 - value, value))


def gamma_upper(s, x) -> np.ndarray:
    """Regularised upper incomplete gamma Q(s, x)."""
    s, x = np.broadcast_arrays(np.asarray(s, float), np.asarray(x, float))
    safe = np.where(x > 0, x, 1.0)
    front = np.exp(-safe + s * np.log(safe) - _lgamma(s))
    term = 1.0 / s
    series = term.copy() if isinstance(term, np.ndarray) else np.asarray(term)
    for n in range(1, _STEPS):
        term = term * safe / (s + n)
        series = series + term
    lower = front * series

    b = safe + 1.0 - s
    c = np.full_like(safe, 1.0 / _TINY)
    d = 1.0 / np.where(np.abs(b) < _TINY, _TINY, b)
    h = d.copy()
    for i in range(1, _STEPS):
        an = -i * (i - s)
        b = b + 2.0
        d = an * d + b
        d = 1.0 / np.where(np.abs(d) < _TINY, _TINY, d)
        c = b + an / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        h = h * d * c
    upper = np.where(safe < s + 1.0, 1.0 - lower, front * h)
    return np.where(np.isnan(x), np.nan, np.where(x <= 0, 1.0, upper))


def f_tail(stat, df1, df2) -> np.ndarray:
    stat = np.maximum(np.asarray(stat, float), 0.0)
    df1, df2 = np.asarray(df1, float), np.asarray(df2, float)
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * stat))


def chi2_tail(stat, df) -> np.ndarray:
    return gamma_upper(np.asarray(df, float) / 2.0, np.asarray(stat, float) / 2.0)


def correlation_p(r, n) -> np.ndarray:
    """Two-sided p of a correlation over n rows, from t with n - 2 degrees of freedom."""
    r, n = np.asarray(r, float), np.asarray(n, float)
    nu = n - 2.0
    bad = np.isnan(r) | (nu <= 0)
    nu = np.where(bad, 1.0, nu)
    r = np.where(bad, 0.0, np.clip(r, -1.0, 1.0))
    # t^2 = r^2 nu / (1 - r^2), so nu / (nu + t^2) is simply 1 - r^2
    return np.where(bad, np.nan, beta_inc(nu / 2.0, 0.5, 1.0 - r * r))
