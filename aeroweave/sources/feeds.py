"""Turning source tables into the common feed layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroweave.dims import CITIES
from aeroweave.functions.weather import kmh_to_ms
from aeroweave.operators.cities import attach_city
from aeroweave.operators.merge import union_feeds
from aeroweave.sources.readers import scan_csv

# Hourly weather source columns and their names here
WEATHER_NAMES = {
    "time": "datetime", "temp": "temperature", "prcp": "precipitation", "wspd": "wind_speed",
    "pres": "pressure", "rhum": "humidity", "wdir": "wind_direction", "coco": "weather_code",
}

# Air-quality portal headers and their names here
STATION_CSV_NAMES = {
    "DatetimeBegin": "datetime", "DatetimeEnd": "datetime_end", "AirQualityStation": "station_name",
    "AirQualityStationEoICode": "station_code", "NO2": "no2", "PM2.5": "pm25", "PM10": "pm10",
    "O3": "o3", "CO": "co", "UnitOfMeasurement": "unit",
}
VALUE_HEADERS = ("Value", "Concentration")
STATION_NUMBERS = ("NO2", "PM2.5", "PM10", "O3", "CO", *VALUE_HEADERS)


def _date_and_hour(df: DataFrame) -> DataFrame:
    return df.withColumns({"date": F.to_date("datetime"), "hour": F.hour("datetime")})


def normalize_weather(df: DataFrame, dim_city: DataFrame | None = None) -> DataFrame:
    """Standard names, wind in m/s, date and hour; city attributes when a dimension is given."""
    named = df.withColumnsRenamed({k: v for k, v in WEATHER_NAMES.items() if k in df.columns})
    if "wind_speed" in named.columns:
        named = named.withColumn("wind_speed", kmh_to_ms(F.col("wind_speed")))
    if "datetime" in named.columns:
        named = _date_and_hour(named.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")))
    return attach_city(named, dim_city) if dim_city is not None else named


def import_station_csv(df: DataFrame, city_key: str, cities=CITIES) -> DataFrame:
    """A manually downloaded air-quality table of one city in the common layout.

    Times that do not parse become null.
    """
    city = next((c for c in cities if c.city_key == city_key), None)
    if city is None:
        raise KeyError(f"unknown city key: {city_key}")
    return _station_layout(df).withColumns({"city": F.lit(city.name), "city_key": F.lit(city_key)})


def _station_layout(df: DataFrame) -> DataFrame:
    present = [F.col(f"`{h}`") for h in VALUE_HEADERS if h in df.columns]
    if present:
        # column names ignore case, so the old headers have to go before "value" can come
        df = df.withColumn("_value", F.coalesce(*present)).drop(*VALUE_HEADERS).withColumnRenamed("_value", "value")
    named = df.withColumnsRenamed({k: v for k, v in STATION_CSV_NAMES.items() if k in df.columns})
    if "datetime" not in named.columns:
        return named
    parsed = F.col("datetime").cast("string").try_cast("timestamp_ntz")
    return _date_and_hour(named.withColumn("datetime", parsed))


def import_many_csv(spark: SparkSession, files: dict[str, str], cities=CITIES) -> DataFrame | None:
    """Stack the station tables of several cities; unknown city keys are skipped.

    Files with the same header are read as one table: the header gives the types (measures are numbers, the rest is text), and
    the city comes from the name of the file a row is in.
    """
    known = {c.city_key: c for c in cities}
    headers: dict[tuple[str, ...], list[str]] = {}
    for key, path in files.items():
        if key in known:
            headers.setdefault(tuple(spark.read.option("header", True).csv(path).columns), []).append(key)
    frames = []
    for columns, keys in headers.items():
        schema = T.StructType([T.StructField(c, T.DoubleType() if c in STATION_NUMBERS else T.StringType()) for c in columns])
        rows = scan_csv(spark, [files[k] for k in keys], schema).withColumn("_file", F.col("_metadata.file_path"))
        of_file = F.lit(None).cast("string")
        for key in keys:
            place = files[key].split("://", 1)[-1].split(":", 1)[-1].rstrip("/")
            inside = F.col("_file").endswith(place) | F.col("_file").contains(place + "/")
            of_file = F.when(inside, key).otherwise(of_file)
        names = F.create_map(*[F.lit(x) for k in keys for x in (k, known[k].name)])
        placed = _station_layout(rows.withColumn("_key", of_file).drop("_file")).withColumnRenamed("_key", "city_key")
        frames.append(placed.withColumn("city", names[F.col("city_key")]))
    return union_feeds(frames) if frames else None
