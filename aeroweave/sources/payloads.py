"""Landed API payloads to rows, one text document per row, without Python in the tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.dims import CITIES
from aeroweave.functions.traffic import congestion_level, traffic_index
from aeroweave.operators.cities import city_table, first_station, match_station_city
from aeroweave.operators.merge import pivot_pollutants

# Slots of a station entry after its id, and the least length of an entry
STATION_SLOTS = ("station_code", "station_name", "city", "state_code", "date_from", "date_to", "longitude", "latitude")
MIN_STATION_SLOTS = 9

# Component numbers in measurement entries
COMPONENT_IDS = {"PM10": 1, "PM2.5": 2, "O3": 3, "CO": 4, "NO2": 5}
POLLUTANT_COMPONENTS = ("NO2", "PM10", "O3")
FIRST_COMPONENT_SLOT = 4  # after end time, index and completeness flag

_STATIONS = "struct<data: map<string, array<string>>>"
_MEASUREMENTS = "struct<data: map<string, map<string, array<string>>>>"
_FLOW = "struct<flowSegmentData: struct<currentSpeed: double, freeFlowSpeed: double, confidence: double>>"


def flatten_stations(df: DataFrame, payload: str = "payload") -> DataFrame:
    """station_id and eight attributes per station; entries with fewer than nine slots are left out."""
    entries = df.select(F.explode(F.from_json(payload, _STATIONS)["data"]).alias("station_id", "_slots"))
    full = entries.filter(F.size("_slots") >= MIN_STATION_SLOTS)
    return full.select("station_id", *[F.col("_slots")[i].alias(n) for i, n in enumerate(STATION_SLOTS, start=1)])


def _slots(item: Column) -> Column:
    """A component item as texts; null for anything but a list that starts with a number."""
    return F.when(item.rlike(r"^\s*\[\s*[-0-9]"), F.from_json(item, "array<string>"))


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with a column that later expressions read, where a plain one would be worked out again in each of them."""
    return df.withColumn(name, F.explode(F.array(value)))


def flatten_measurements(df: DataFrame, payload: str = "payload", components=tuple(COMPONENT_IDS)) -> DataFrame:
    """station_id, datetime, datetime_end, component, value from nested measurement payloads.

    Entries without component items, and components without a value, give no row. When an
    entry lists a component twice the first one counts. Times and values that do not parse
    become null.
    """
    stations = df.select(F.explode(F.from_json(payload, _MEASUREMENTS)["data"]).alias("station_id", "_times"))
    entries = stations.select("station_id", F.explode("_times").alias("_start", "_slots"))
    items = F.slice("_slots", F.lit(FIRST_COMPONENT_SLOT), F.size("_slots") - F.lit(FIRST_COMPONENT_SLOT - 1))
    listed = entries.filter(F.size("_slots") >= FIRST_COMPONENT_SLOT).select(
        "station_id", "_start", F.col("_slots")[0].alias("_end"), items.alias("_items")
    )
    parsed = _once(listed, F.transform("_items", _slots), "_parsed").drop("_items")
    numbered = _once(parsed, F.transform("_parsed", lambda p: F.when(F.size(p) > 1, p[0].try_cast("double"))), "_ids")
    wanted = F.array(*[
        F.struct(F.lit(name).alias("name"), F.array_position("_ids", F.lit(float(COMPONENT_IDS[name]))).alias("at"))
        for name in components
    ])
    found = numbered.select("*", F.explode(F.filter(wanted, lambda c: c["at"] > 0)).alias("_c"))
    value = F.get(F.get("_parsed", F.col("_c.at").cast("int") - 1), F.lit(1))
    rows = found.withColumn("_value", value).filter(F.col("_value").isNotNull())
    return rows.select(
        "station_id",
        F.col("_start").try_cast("timestamp_ntz").alias("datetime"),
        F.col("_end").try_cast("timestamp_ntz").alias("datetime_end"),
        F.col("_c.name").alias("component"),
        F.col("_value").try_cast("double").alias("value"),
    )


def air_from_payloads(
    stations: DataFrame, measurements: DataFrame, payload: str = "payload", cities=CITIES, pollutants=POLLUTANT_COMPONENTS,
) -> DataFrame:
    """Hourly air-quality feed of the first station of each city, one column per pollutant.

    ``stations`` and ``measurements`` hold one landed document per row. A station serves every city it matches; of a
    city's stations the one with the least id is taken, so what is joined to the measurements is bounded by the city list.
    """
    placed = match_station_city(flatten_stations(stations, payload), cities)
    chosen = first_station(placed).select("station_id", "station_name", "city_key")
    names = city_table(stations.sparkSession, cities).select("city_key", F.col("name").alias("city"))
    readings = flatten_measurements(measurements, payload, pollutants).join(
        F.broadcast(chosen.join(F.broadcast(names), "city_key")), "station_id")
    dated = readings.select(
        "city", "city_key", "datetime", F.to_date("datetime").alias("date"), F.hour("datetime").alias("hour"),
        "station_name", "station_id", F.col("component").alias("pollutant"), "value")
    return pivot_pollutants(dated, pollutants)


def normalize_traffic_flow(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Speeds and confidence of a flow payload, with congestion level and traffic index."""
    flow = F.from_json(payload, _FLOW)["flowSegmentData"]
    current, free = F.col("current_speed"), F.col("free_flow_speed")
    return (
        df.withColumn("_flow", flow)
        .withColumns({
            "current_speed": F.col("_flow.currentSpeed"),
            "free_flow_speed": F.col("_flow.freeFlowSpeed"),
            "confidence": F.col("_flow.confidence"),
        })
        .withColumns({"congestion_level": congestion_level(current, free), "traffic_index": traffic_index(current, free)})
        .drop("_flow", payload)
    )
