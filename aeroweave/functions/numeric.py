"""Null-safe arithmetic."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_range(value: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to bounds. A null stays null, which ``least``/``greatest`` would not keep."""
    clipped = value
    if hi is not None:
        clipped = F.when(value > hi, F.lit(float(hi))).otherwise(clipped)
    if lo is not None:
        clipped = F.when(value < lo, F.lit(float(lo))).otherwise(clipped)
    return clipped


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def row_mean(columns: list[Column]) -> Column:
    """Mean of the non-null values of a row; null when there are none."""
    total = reduce(add, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns])
    filled = reduce(add, [c.isNotNull().cast("int") for c in columns])
    return F.try_divide(total, filled)


def round_to(value: Column, digits: int) -> Column:
    return F.round(value, digits)


def outside(value: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """True where a value lies strictly beyond a bound; null counts as inside."""
    tests = ([value < lo] if lo is not None else []) + ([value > hi] if hi is not None else [])
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))
