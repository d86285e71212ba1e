"""Test statistics as Column expressions and p-values as Arrow-batched UDFs.

Sufficient statistics (count, mean, variance, rank sums) are always computed
by Spark aggregations; only the final distribution tail — a few rows, one per
test or simulation — goes through a vectorized ``pandas_udf``.  SciPy is not
available, so the Student-t tail uses the regularized incomplete beta
function (continued fraction, evaluated for a whole Arrow batch at once).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_TINY = 1e-300
_lgamma = np.vectorize(math.lgamma, otypes=[float])
STIRLING_FROM = 50.0    # from here on the series below is exact to the last digits
NORMAL_FROM = 1e5       # degrees of freedom from which Student's tail comes from a normal one
_erfc = np.vectorize(math.erfc, otypes=[float])


def _stirling(x):
    """ln Γ(x) − ((x − ½) ln x − x + ½ ln 2π), for large x."""
    i = 1.0 / (x * x)
    return (1 / 12 - (1 / 360 - (1 / 1260 - i / 1680) * i) * i) / x


def log_beta(a, b):
    """ln B(a, b), element-wise, without the difference of large logarithms: with s the smaller
    and g the larger one, ln Γ(g + s) − ln Γ(g) = (g − ½) ln(1 + s/g) + s ln(g + s) − s + corrections."""
    s, g = np.minimum(a, b), np.maximum(a, b)
    out = _lgamma(s) + _lgamma(np.minimum(g, STIRLING_FROM)) - _lgamma(np.minimum(g, STIRLING_FROM) + s)
    big = g > STIRLING_FROM
    if np.any(big):
        sb, gb = s[big], g[big]
        rise = (gb - 0.5) * np.log1p(sb / gb) + sb * np.log(gb + sb) - sb + _stirling(gb + sb) - _stirling(gb)
        out[big] = _lgamma(sb) - rise
    return out


def _betacf(a, b, x, iters: int = 5000, eps: float = 1e-15):
    """Continued fraction of the incomplete beta function; an error if it doesn't settle."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < _TINY, _TINY, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < _TINY, _TINY, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < _TINY, _TINY, c)
        d = 1.0 / d
        de = d * c
        h = h * de
        if np.all(np.abs(de - 1.0) < eps):
            return h
    raise ArithmeticError(f"incomplete beta function: no convergence in {iters} steps")


def betainc(a, b, x):
    """Regularized incomplete beta I_x(a, b), element-wise."""
    a, b, x = (np.asarray(v, dtype=float) for v in np.broadcast_arrays(a, b, x))
    out = np.full(x.shape, np.nan)
    ok = np.isfinite(a) & np.isfinite(b) & np.isfinite(x) & (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    out[ok & (x == 0)] = 0.0
    out[ok & (x == 1)] = 1.0
    mid = ok & (x > 0) & (x < 1)
    if mid.any():
        am, bm, xm = a[mid], b[mid], x[mid]
        lbt = am * np.log(xm) + bm * np.log1p(-xm) - log_beta(am, bm)
        bt = np.exp(lbt)
        direct = xm < (am + 1.0) / (am + bm + 2.0)
        r = np.empty_like(xm)
        if direct.any():
            r[direct] = bt[direct] * _betacf(am[direct], bm[direct], xm[direct]) / am[direct]
        if (~direct).any():
            nd = ~direct
            r[nd] = 1.0 - bt[nd] * _betacf(bm[nd], am[nd], 1.0 - xm[nd]) / bm[nd]
        out[mid] = r
    return out


def t_sf(t, df):
    """P(T > t) for Student's t with ``df`` degrees of freedom.

    Up to ``NORMAL_FROM`` by the incomplete beta function; beyond, the normal tail at
    z = √w · (1 + (w + 3) / (48 a²)) with a = df − ½ and w = a ln(1 + t²/df), whose error is of the order df⁻³."""
    t, df = (np.array(v, dtype=float) for v in np.broadcast_arrays(t, df))
    large = df > NORMAL_FROM
    tail = 0.5 * betainc(np.where(large, np.nan, df) / 2.0, 0.5, df / (df + t * t))
    if np.any(large):
        a = np.where(large, df, 1.0) - 0.5
        w = a * np.log1p(t * t / np.where(large, df, 1.0))
        tail = np.where(large, norm_sf(np.sqrt(w) * (1 + (w + 3) / (48 * a * a))), tail)
    return np.where(t >= 0, tail, 1.0 - tail)


def norm_sf(z):
    z = np.asarray(z, dtype=float)
    return 0.5 * _erfc(z / math.sqrt(2.0))


def t_pvalue(t, df, alternative: str = "two-sided"):
    if alternative == "two-sided":
        return np.minimum(1.0, 2.0 * t_sf(np.abs(t), df))
    if alternative == "greater":
        return t_sf(t, df)
    if alternative == "less":
        return t_sf(-np.asarray(t, dtype=float), df)
    raise ValueError(alternative)


@F.pandas_udf(DoubleType())
def _t_two(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_pvalue(t.to_numpy(float), df.to_numpy(float), "two-sided"))


@F.pandas_udf(DoubleType())
def _t_greater(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_pvalue(t.to_numpy(float), df.to_numpy(float), "greater"))


@F.pandas_udf(DoubleType())
def _t_less(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_pvalue(t.to_numpy(float), df.to_numpy(float), "less"))


@F.pandas_udf(DoubleType())
def _norm_sf_udf(z: pd.Series) -> pd.Series:
    return pd.Series(norm_sf(z.to_numpy(float)))


def t_pvalue_col(t: Column, df: Column, alternative: str = "two-sided") -> Column:
    fn = {"two-sided": _t_two, "greater": _t_greater, "less": _t_less}[alternative]
    return fn(t.cast("double"), df.cast("double"))


def norm_sf_col(z: Column) -> Column:
    return _norm_sf_udf(z.cast("double"))


def exact_u_counts(n: Column, m: Column) -> Column:
    """Array over u = 0…n·m: in how many of the C(n+m, n) orders of two samples without ties
    U is u.  The counts are the coefficients of Π_{i=1..n} (1 − q^(m+i)) / (1 − q^i), folded factor
    by factor: a multiplication takes away the entry m+i places before, a division adds
    up with the entry i places before.  Meant for small samples: n·m + 1 entries."""
    one = F.transform(F.sequence(F.lit(0), (n * m).cast("int")), lambda u: F.when(u == 0, 1).otherwise(0).cast("long"))

    def factor(a, i):
        less = F.transform(a, lambda x, u: x - F.coalesce(F.get(a, u - (m + i).cast("int")), F.lit(0)))
        return F.aggregate(less, F.array().cast("array<bigint>"), lambda done, x: F.concat(
            done, F.array(x + F.coalesce(F.get(done, F.size(done) - i), F.lit(0)))))

    return F.aggregate(F.sequence(F.lit(1), n.cast("int")), one, factor)


def exact_u_sf(n: Column, m: Column, u: Column) -> Column:
    """P(U ≥ u) of samples of n and m values without ties."""
    counts = exact_u_counts(n, m)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x)
    return total(F.slice(counts, F.ceil(u).cast("int") + 1, F.size(counts))) / total(counts).cast("double")


def welch_columns(n_a: Column, m_a: Column, v_a: Column, n_b: Column, m_b: Column,
                  v_b: Column) -> tuple[Column, Column]:
    """Welch t and Satterthwaite df from per-group count, mean and sample variance."""
    se_a = v_a / n_a
    se_b = v_b / n_b
    s2 = se_a + se_b
    t = F.try_divide(m_a - m_b, F.sqrt(s2))
    df = F.try_divide(s2 * s2, se_a * se_a / (n_a - 1) + se_b * se_b / (n_b - 1))
    return t, df
