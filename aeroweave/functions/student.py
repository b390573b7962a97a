"""Two-sided p-value of a Pearson correlation."""

from __future__ import annotations

from math import asin, exp, lgamma, log, log1p, pi

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_NODES, _WEIGHTS = np.polynomial.legendre.leggauss(32)
_PANELS = 40
_DROP = 50.0  # what is left after the integrand has fallen by exp(-50) is below the last digit


def _log_beta_half(a: float) -> float:
    """ln B(a, 1/2); for large a by series, where the gamma logarithms would cancel."""
    if a < 1e4:
        return lgamma(a) + lgamma(0.5) - lgamma(a + 0.5)
    return lgamma(0.5) - (0.5 * log(a) - 1 / (8 * a) + 1 / (192 * a**3))


def pearson_p_value(r: float, n: float) -> float:
    """Probability of a correlation at least this strong between unrelated normal samples.

    With v = n - 2, it is the integral of cos(s)^(v - 1) from asin|r| to pi / 2, over the same
    from 0. The part in which the integrand is not negligible is cut into panels, each by a Gauss rule;
    logarithms keep tiny values. There is one formula for every n.
    """
    if r is None or n is None or np.isnan(r) or n <= 2:
        return np.nan
    power, start = n - 3.0, asin(min(1.0, abs(r)))
    if abs(r) >= 1.0:
        return 0.0
    if r == 0.0:
        return 1.0
    top = 0.5 * log1p(-r * r)

    def fall(s):
        return power * (0.5 * np.log1p(-np.minimum(np.sin(s) ** 2, 1 - 1e-16)) - top)

    low, high = start, pi / 2
    if fall(np.float64(high)) < -_DROP:
        for _ in range(200):
            middle = (low + high) / 2
            low, high = (middle, high) if fall(np.float64(middle)) > -_DROP else (low, middle)
    half = (high - start) / _PANELS / 2
    centres = start + half * (2 * np.arange(_PANELS) + 1)
    points = centres[:, None] + half * _NODES
    area = float((np.exp(fall(points)) * _WEIGHTS).sum()) * half
    return min(1.0, exp(power * top + log(area) + log(2.0) - _log_beta_half((n - 2) / 2.0)))


@pandas_udf(DoubleType())
def student_t_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([pearson_p_value(ri, ni) for ri, ni in zip(r, n)], dtype="float64")
