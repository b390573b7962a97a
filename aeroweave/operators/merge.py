"""Joining the feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.calendar import STUDY_SEASON_LABELS, day_of_week, hour_floor, is_weekend, season
from aeroweave.functions.weather import temp_range
from aeroweave.operators.cities import standardize_city
from aeroweave.operators.schema import ensure_datetime, select_available

KEYS = ["city_key", "datetime"]

# The columns each feed contributes to the unified table
GOLD_WEATHER = [
    "city_key", "datetime", "city", "lat", "lon", "temperature", "humidity", "precipitation",
    "wind_speed", "wind_direction", "pressure", "weather_code", "date", "hour", "month",
    "day_of_week", "is_night", "is_weekday",
]
GOLD_AIR = ["city_key", "datetime", "no2", "pm10", "o3", "aqi_avg"]
GOLD_TRAFFIC = [
    "city_key", "datetime", "current_speed", "free_flow_speed", "congestion_level", "traffic_index",
    "is_rush_hour", "is_weekend", "is_holiday", "holiday_name",
]
STATION_MEASURES = ["no2", "pm25", "pm10", "o3", "co"]
STUDY_WEATHER = [
    "temperature", "temp_min", "temp_max", "wind_speed", "precipitation", "pressure", "wpgt",
]
STUDY_TRAFFIC = ["traffic_index", "congestion_level", "current_speed", "free_flow_speed"]


def gold_merge(weather: DataFrame, air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Weather, air and traffic rows of the same city and instant.

    Both joins use the same keys, so each feed is shuffled once.
    """
    feeds = zip((weather, air, traffic), (GOLD_WEATHER, GOLD_AIR, GOLD_TRAFFIC))
    parts = [select_available(ensure_datetime(df), cols) for df, cols in feeds]
    return reduce(lambda left, right: left.join(right, KEYS, "inner"), parts)


def merge_prepare(df: DataFrame) -> DataFrame:
    """Standard ``city_key`` and the hour the row belongs to."""
    df = ensure_datetime(df)
    if "city" in df.columns:
        df = standardize_city(df)
    elif "city_key" not in df.columns:
        raise ValueError("no city or city_key column found")
    return df.withColumn("datetime_hour", hour_floor(F.col("datetime")))


def station_to_city_hour(air: DataFrame) -> DataFrame:
    """Mean over a city's stations per hour, for feeds that name stations."""
    if "station_code" not in air.columns:
        return air
    measures = [c for c in STATION_MEASURES if c in air.columns]
    return air.groupBy("city_key", "datetime_hour").agg(*[F.avg(c).alias(c) for c in measures])


def _suffixed(left: DataFrame, right: DataFrame, keys, suffix: str) -> DataFrame:
    clashes = {c: c + suffix for c in right.columns if c in left.columns and c not in keys}
    return right.withColumnsRenamed(clashes)


def merge_feeds(weather: DataFrame, air: DataFrame, traffic: DataFrame, how: str = "outer") -> DataFrame:
    """Three-way merge on city and hour: ``inner``, ``outer``, ``left`` or ``right``.

    Columns that occur twice keep their name on the left and get ``_aq`` or ``_traffic`` on
    the right; the second city name is dropped and the hour becomes ``datetime``.
    """
    if how not in ("inner", "outer", "left", "right"):
        raise ValueError(f"unknown merge strategy: {how}")
    keys = ["city_key", "datetime_hour"]
    merged = merge_prepare(weather)
    for feed, suffix in ((station_to_city_hour(merge_prepare(air)), "_aq"), (merge_prepare(traffic), "_traffic")):
        merged = merged.join(_suffixed(merged, feed, keys, suffix), keys, how)
    return merged.drop("city_aq", "city_traffic", "datetime").withColumnRenamed("datetime_hour", "datetime")


def air_daily(air: DataFrame) -> DataFrame:
    """Daily means of the three pollutants per city."""
    return air.groupBy("city", F.to_date("date").alias("date")).agg(
        *[F.avg(c).alias(c) for c in ("no2", "pm10", "o3")]
    )


def study_merge(air: DataFrame, weather: DataFrame, traffic: DataFrame) -> DataFrame:
    """Daily air means joined with daily weather and traffic, plus calendar columns."""
    keys = ["city", "date"]

    def daily(df: DataFrame, cols) -> DataFrame:
        return select_available(df.withColumn("date", F.to_date("date")), [*keys, *cols])

    merged = air_daily(air).join(daily(weather, STUDY_WEATHER), keys).join(daily(traffic, STUDY_TRAFFIC), keys)
    derived = {}
    if {"temp_max", "temp_min"} <= set(merged.columns):
        derived["temp_range"] = temp_range(F.col("temp_max"), F.col("temp_min"))
    weekday = day_of_week(F.col("date"))
    month = F.month("date")
    derived |= {
        "month": month, "day_of_week": weekday, "is_weekend": is_weekend(weekday),
        "season": season(month, STUDY_SEASON_LABELS),
    }
    return merged.withColumns(derived)


def merge_pollutants(frames: list[DataFrame]) -> DataFrame:
    """Full outer merge of one table per pollutant on the keys they share, or a plain stack.

    Where the pollutants are still in long form, ``pivot_pollutants`` gives the same table
    with a single shuffle.
    """
    candidates = ["city", "city_key", "datetime", "date", "hour", "station_name", "station_id", "station_code"]
    keys = [k for k in candidates if all(k in f.columns for f in frames)]
    if not keys:
        return union_feeds(frames)
    return reduce(lambda left, right: left.join(right, keys, "outer"), frames)


def pivot_pollutants(df: DataFrame, pollutants=("NO2", "PM10", "O3")) -> DataFrame:
    """Long rows to one column per pollutant, averaging repeats within an hour."""
    candidates = ["city", "city_key", "datetime", "date", "hour", "station_name", "station_id"]
    keys = [k for k in candidates if k in df.columns]
    known = df.dropna(subset=[*keys, "pollutant", "value"])
    wide = known.groupBy(*keys).pivot("pollutant", list(pollutants)).avg("value")
    return wide.withColumnsRenamed({p: p.lower().replace(".", "") for p in pollutants})


def union_feeds(frames: list[DataFrame]) -> DataFrame:
    """Stack frames by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def sort_city_time(df: DataFrame, total: bool = False) -> DataFrame:
    """Order by city and time: within partitions for writing, or as a total order to show."""
    return df.orderBy(*KEYS) if total else df.sortWithinPartitions(*KEYS)
