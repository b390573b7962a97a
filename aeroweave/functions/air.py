"""Air-quality indices and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeroweave.functions.numeric import row_mean

# Fixed values: (concentration, index) points joined by straight lines; the last line goes on
PM25_POINTS = [(0.0, 0), (12.0, 50), (35.4, 100), (55.4, 150), (150.4, 200), (250.4, 300), (500.0, 400)]
PM10_POINTS = [(0.0, 0), (54.0, 50), (154.0, 100), (254.0, 150), (354.0, 200), (424.0, 300), (604.0, 400)]

# Fixed value: keeps the PM ratio defined where PM10 is zero
RATIO_GUARD = 1e-6


def piecewise_linear(value: Column, points) -> Column:
    """Interpolate between points; the outer segments extend without end."""
    result = None
    for (x0, y0), (x1, y1) in reversed(list(zip(points, points[1:]))):
        line = F.lit(float(y0)) + F.lit((y1 - y0) / (x1 - x0)) * (value - F.lit(x0))
        result = line if result is None else F.when(value <= F.lit(x1), line).otherwise(result)
    return F.when(value.isNotNull(), result)


def pm25_aqi(pm25: Column) -> Column:
    return piecewise_linear(pm25, PM25_POINTS)


def pm10_aqi(pm10: Column) -> Column:
    return piecewise_linear(pm10, PM10_POINTS)


def aqi_avg(pollutants: list[Column]) -> Column:
    return row_mean(pollutants)


def pm25_pm10_ratio(pm25: Column, pm10: Column) -> Column:
    return F.try_divide(pm25, pm10 + F.lit(RATIO_GUARD))


def no2_o3_ratio(no2: Column, o3: Column) -> Column:
    return F.try_divide(no2, o3)


def exceeds(value: Column, limit: float) -> Column:
    """0/1 flag; an unknown value is not an exceedance."""
    return F.when(value > F.lit(float(limit)), 1).otherwise(0)
