"""Unit repair decided from the extremes of a whole column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.plans.small import attach_scalars

# Limits beyond which a column cannot be in its standard unit
FAHRENHEIT_ABOVE = 100
KMH_ABOVE = 50
BAR_BELOW = 10
KILOPASCAL_BELOW = 100
CO_MILLIGRAM_BELOW = 10
MILLIGRAM_BELOW = 1
FRACTION_UP_TO = 1
POLLUTANTS = ("no2", "pm25", "pm10", "o3", "co")


def _highest(column: str) -> Column:
    return F.col(f"_max_{column}")


def _lowest(column: str) -> Column:
    return F.col(f"_min_{column}")


def _weather(c: str) -> Column:
    value = F.col(c)
    if c == "temperature":
        return F.when(_highest(c) > FAHRENHEIT_ABOVE, (value - 32) * 5 / F.lit(9)).otherwise(value)
    if c == "wind_speed":
        return F.when(_highest(c) > KMH_ABOVE, value / F.lit(3.6)).otherwise(value)
    return (
        F.when(_lowest(c) < BAR_BELOW, value * 1000)
        .when(_lowest(c) < KILOPASCAL_BELOW, value * 10)
        .otherwise(value)
    )


def _air(c: str) -> Column:
    limit = CO_MILLIGRAM_BELOW if c == "co" else MILLIGRAM_BELOW
    return F.when(_highest(c) < limit, F.col(c) * 1000).otherwise(F.col(c))


def _traffic(c: str) -> Column:
    return F.when(_highest(c) <= FRACTION_UP_TO, F.col(c) * 100).otherwise(F.col(c))


_RULES = {
    "weather": (("temperature", "wind_speed", "pressure"), _weather),
    "air_quality": (POLLUTANTS, _air),
    "traffic": (("traffic_index",), _traffic),
}


def standardize_units(df: DataFrame, feed: str) -> DataFrame:
    """Convert measures that are evidently in another unit; one pass finds all extremes."""
    columns, rule = _RULES[feed]
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    extremes = df.agg(*[
        f(c).alias(f"_{name}_{c}") for c in present for name, f in (("max", F.max), ("min", F.min))
    ])
    return attach_scalars(df, extremes).withColumns({c: rule(c) for c in present}).select(*df.columns)


def standardize_units_weather(df: DataFrame) -> DataFrame:
    return standardize_units(df, "weather")


def standardize_units_air(df: DataFrame) -> DataFrame:
    return standardize_units(df, "air_quality")


def standardize_units_traffic(df: DataFrame) -> DataFrame:
    return standardize_units(df, "traffic")
