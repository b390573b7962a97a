"""Expected unit and range per measure."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Measure, unit, lowest and highest expected value
UNIT_RANGES = [
    ("temperature", "°C", -30.0, 50.0),
    ("humidity", "%", 0.0, 100.0),
    ("wind_speed", "m/s", 0.0, 200.0),
    ("pressure", "hPa", 800.0, 1100.0),
    ("no2", "μg/m³", 0.0, 500.0),
    ("pm25", "μg/m³", 0.0, 500.0),
    ("pm10", "μg/m³", 0.0, 1000.0),
    ("o3", "μg/m³", 0.0, 500.0),
    ("co", "μg/m³", 0.0, 50000.0),
    ("traffic_index", "index", 0.0, 100.0),
]


def dim_units(spark: SparkSession) -> DataFrame:
    """measure, unit, lo, hi."""
    measures, units, lows, highs = zip(*UNIT_RANGES)
    return spark.createDataFrame(pa.table({
        "measure": list(measures), "unit": list(units), "lo": list(lows), "hi": list(highs),
    }))
