"""Tails of the t, F and chi-square distributions, from the incomplete beta and gamma functions."""

from __future__ import annotations

from math import exp, inf, isnan, lgamma, log, log1p, nan

import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

_TINY, _CLOSE, _STEPS = 1e-300, 1e-16, 100_000


def _fraction(first: float, terms) -> float:
    """Value of ``first + a1 / (b1 + a2 / (b2 + ...))`` from its (a, b), by Lentz's method."""
    value = first or _TINY
    c, d = value, 0.0
    for a, b in terms:
        d = 1.0 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        value *= c * d
        if abs(c * d - 1.0) < _CLOSE:
            break
    return value


def incomplete_beta(a: float, b: float, x: float, rest: float | None = None) -> float:
    """Regularised I_x(a, b). ``rest`` is 1 - x where that is known with more digits."""
    rest = 1.0 - x if rest is None else rest
    if isnan(a + b + x) or a <= 0 or b <= 0:
        return nan
    if x <= 0.0 or rest >= 1.0:
        return 0.0
    if x >= 1.0 or rest <= 0.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, rest, x)

    def terms():
        yield 1.0, 1.0
        for m in range(1, _STEPS):
            yield -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1)), 1.0
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    front = lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * (log(rest) if rest < 0.5 else log1p(-x))
    return exp(front) / a * _fraction(0.0, terms())


def upper_gamma(a: float, x: float) -> float:
    """Regularised Q(a, x), the share beyond x."""
    if isnan(a + x) or a <= 0:
        return nan
    if x <= 0.0:
        return 1.0
    if x == inf:
        return 0.0
    front = exp(a * log(x) - x - lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        for n in range(1, _STEPS):
            term *= x / (a + n)
            total += term
            if term < total * _CLOSE:
                break
        return 1.0 - front * total

    def terms():
        yield 1.0, x + 1.0 - a
        for n in range(1, _STEPS):
            yield -n * (n - a), x + 2 * n + 1.0 - a

    return front * _fraction(0.0, terms())


def t_tail(t: float, freedom: float) -> float:
    """Probability of a |t| at least this large."""
    if isnan(t + freedom) or freedom <= 0:
        return nan
    return incomplete_beta(freedom / 2, 0.5, freedom / (freedom + t * t), t * t / (freedom + t * t)) if abs(t) != inf else 0.0


def f_tail(f: float, between: float, within: float) -> float:
    """Probability of an F at least this large."""
    if isnan(f + between + within) or between <= 0 or within <= 0:
        return nan
    if f <= 0:
        return 1.0
    whole = within + between * f
    return incomplete_beta(within / 2, between / 2, within / whole, between * f / whole) if f != inf else 0.0


def chi_square_tail(x: float, freedom: float) -> float:
    """Probability of a chi-square value at least this large."""
    return upper_gamma(freedom / 2, x / 2)


@pandas_udf(DoubleType())
def t_p_value(t: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([t_tail(*v) for v in zip(t, freedom)], dtype="float64")


@pandas_udf(DoubleType())
def f_p_value(f: pd.Series, between: pd.Series, within: pd.Series) -> pd.Series:
    return pd.Series([f_tail(*v) for v in zip(f, between, within)], dtype="float64")


@pandas_udf(DoubleType())
def chi_square_p_value(x: pd.Series, freedom: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(*v) for v in zip(x, freedom)], dtype="float64")
