"""Distribution tails for p-values, in pure Python.

SciPy is not available. These are applied to already-aggregated rows (one
per feature), never per input row: the library wraps them in a pandas UDF
over the small statistics table.

Regularised incomplete gamma (series / continued fraction) and beta
(Lentz continued fraction), following the textbook formulations.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_EPS = 1e-15
_TINY = 1e-300
_MAXIT = 10_000


def _gammainc_lower_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    ap = a
    for _ in range(_MAXIT):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * _EPS:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gammainc_upper_cf(a: float, x: float) -> float:
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _MAXIT):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        if abs(d) < _TINY:
            d = _TINY
        c = b + an / c
        if abs(c) < _TINY:
            c = _TINY
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        return 1.0 - _gammainc_lower_series(a, x)
    return _gammainc_upper_cf(a, x)


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = 1.0
    d = 1.0 - qab * x / qap
    if abs(d) < _TINY:
        d = _TINY
    d = 1.0 / d
    h = d
    for m in range(1, _MAXIT):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        if abs(d) < _TINY:
            d = _TINY
        c = 1.0 + aa / c
        if abs(c) < _TINY:
            c = _TINY
        d = 1.0 / d
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        if abs(d) < _TINY:
            d = _TINY
        c = 1.0 + aa / c
        if abs(c) < _TINY:
            c = _TINY
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def _finite(*vals) -> bool:
    return all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in vals)


def chi2_sf(x: float, dof: float) -> float | None:
    if not _finite(x, dof) or dof <= 0:
        return None
    return gammaincc(dof / 2.0, x / 2.0)


def t_two_sided(t: float, dof: float) -> float | None:
    if not _finite(t, dof) or dof <= 0:
        return None
    if math.isinf(t):
        return 0.0
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def f_sf(f: float, d1: float, d2: float) -> float | None:
    if not _finite(f, d1, d2) or d1 <= 0 or d2 <= 0:
        return None
    if math.isinf(f):
        return 0.0
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def corr_p_value(r: float, n: float) -> float | None:
    """Two-sided p of a Pearson correlation (t with n-2 dof)."""
    if not _finite(r, n) or n < 3:
        return None
    if abs(r) >= 1.0:
        return 0.0
    t = r * math.sqrt((n - 2) / (1.0 - r * r))
    return t_two_sided(t, n - 2)


def _vec(fn, *series: pd.Series) -> pd.Series:
    out = [fn(*[None if pd.isna(v) else float(v) for v in vals]) for vals in zip(*series)]
    return pd.Series(out, dtype="Float64")  # nullable: undefined values arrive as NULL


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _vec(chi2_sf, x, dof)


@F.pandas_udf(T.DoubleType())
def corr_p_udf(r: pd.Series, n: pd.Series) -> pd.Series:
    return _vec(corr_p_value, r, n)


@F.pandas_udf(T.DoubleType())
def f_sf_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(f_sf, f, d1, d2)
