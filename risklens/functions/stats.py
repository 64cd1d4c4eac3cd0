"""Tail probabilities of test statistics; they run on aggregated rows only."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Lentz evaluation of the continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                    -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 + num * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + num / np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def incomplete_beta(a, b, x) -> np.ndarray:
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    out = np.where(x >= 1, 1.0, 0.0)
    inside = (x > 0) & (x < 1)
    if inside.any():
        ai, bi, xi = a[inside], b[inside], x[inside]
        flip = xi > (ai + 1) / (ai + bi + 2)
        p, q = np.where(flip, bi, ai), np.where(flip, ai, bi)
        t = np.where(flip, 1 - xi, xi)
        front = np.exp(_lgamma(ai + bi) - _lgamma(ai) - _lgamma(bi)
                       + p * np.log(t) + q * np.log1p(-t))
        v = front * _beta_fraction(p, q, t) / p
        out[inside] = np.where(flip, 1 - v, v)
    return out


def t_two_sided(t, dof) -> np.ndarray:
    """P(|T| >= t); the tail is small for large t, so it is taken directly."""
    t, dof = np.asarray(t, dtype=float), np.asarray(dof, dtype=float)
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


@pandas_udf(DoubleType())
def t_p_value(t: pd.Series, dof: pd.Series) -> pd.Series:
    ok = t.notna() & dof.notna() & (dof > 0)
    out = np.full(len(t), np.nan)
    if ok.any():
        out[ok.to_numpy()] = t_two_sided(t[ok].to_numpy(), dof[ok].to_numpy())
    return pd.Series(out).where(ok.to_numpy(), None)


@pandas_udf(DoubleType())
def chi2_1_p_value(stat: pd.Series) -> pd.Series:
    ok = stat.notna().to_numpy()
    out = np.full(len(stat), np.nan)
    if ok.any():
        out[ok] = _erfc(np.sqrt(stat.to_numpy()[ok] / 2))
    return pd.Series(out).where(ok, None)


# Workers need no copy of this package: the functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
