"""Row lags and pressure tendency per city."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.calendar import seconds_between
from aeroweave.operators.schema import SEQ
from aeroweave.plans.chunks import TARGET_ROWS, Density
from aeroweave.plans.shift import Shift, shift_rows

KEYS = ("city_key",)
DEFAULT_LAGS = (1, 2, 3, 6, 12, 24)


def _order(df: DataFrame, ts: str) -> tuple[str, ...]:
    """Time, then source order where a feed still carries it."""
    return (ts, SEQ) if SEQ in df.columns else (ts,)


def _lag_shifts(df: DataFrame, cols, lags) -> list[Shift]:
    return [Shift(c, n, f"{c}_lag_{n}h") for c in cols if c in df.columns for n in lags]


def lag_features(
    df: DataFrame, cols, lags=DEFAULT_LAGS, keys=KEYS, ts: str = "datetime",
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """``{column}_lag_{n}h``: the value n rows earlier, which is n hours on a full hourly grid."""
    for needed in (ts, *keys):
        if needed not in df.columns:
            raise ValueError(f"column required for lag features: {needed}")
    return shift_rows(df, _lag_shifts(df, cols, lags), keys, _order(df, ts), target_rows)


def pressure_and_lags(
    df: DataFrame, cols, lags, keys=KEYS, ts: str = "datetime", target_rows: int = TARGET_ROWS,
    density: Density | None = None,
) -> DataFrame:
    """Pressure tendency and lags in one pass over the ordered rows."""
    shifts = _lag_shifts(df, cols, lags)
    has_pressure = "pressure" in df.columns
    if has_pressure:
        shifts += [Shift("pressure", 1, "_prev_pressure"), Shift(ts, 1, "_prev_time")]
    shifted = shift_rows(df, shifts, keys, _order(df, ts), target_rows, density)
    if not has_pressure:
        return shifted
    change = F.col("pressure") - F.col("_prev_pressure")
    elapsed = seconds_between(F.col(ts), F.col("_prev_time"))
    return shifted.withColumns({
        "pressure_change": change,
        "pressure_change_rate": F.try_divide(change, elapsed) * 3600,
    }).drop("_prev_pressure", "_prev_time")


def pressure_change(df: DataFrame, keys=KEYS, ts: str = "datetime", target_rows: int = TARGET_ROWS) -> DataFrame:
    """Difference to the previous row, and per hour elapsed (null when no time elapsed)."""
    if "pressure" not in df.columns:
        raise ValueError("column required for pressure change: pressure")
    return pressure_and_lags(df, [], [], keys, ts, target_rows)
