"""City names, station matching and the set of cities the feeds share."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeroweave.dims import CITIES, city_aliases
from aeroweave.plans.small import broadcast_if_small

EARTH_RADIUS_KM = 6371.0088


def standardize_city(df: DataFrame, dim_city: DataFrame | None = None, column: str = "city") -> DataFrame:
    """Set ``city_key`` from a city name in any known spelling.

    Unknown names fall back to their trimmed lower-case form, and rows without a name keep the ``city_key`` they
    have. The built-in alias table is fixed; a caller's own dimension is broadcast only if it proves small.
    """
    folded = F.lower(F.trim(F.col(column).cast("string")))
    if dim_city is None:
        aliases = city_aliases()
        spellings = F.broadcast(df.sparkSession.createDataFrame(
            pa.table({"_spelling": list(aliases), "_key": list(aliases.values())})
        ))
    else:
        spellings = broadcast_if_small(
            dim_city.select("city_key", F.explode("name_variations").alias("_name"))
            .groupBy(F.lower(F.trim("_name")).alias("_spelling"))
            .agg(F.min("city_key").alias("_key"))
        )
    named = df.withColumn("_folded", folded)
    joined = named.join(spellings, F.col("_folded") == F.col("_spelling"), "left")
    own = [F.col("city_key")] if "city_key" in df.columns else []
    key = F.coalesce(F.col("_key"), F.col("_folded"), *own)
    return joined.withColumn("city_key", key).drop("_folded", "_spelling", "_key")


def attach_city(df: DataFrame, dim_city: DataFrame, cols=("name", "lat", "lon")) -> DataFrame:
    """City attributes by ``city_key``; the name arrives as ``city``."""
    attributes = dim_city.select("city_key", *[F.col(c).alias("city" if c == "name" else c) for c in cols])
    return df.join(broadcast_if_small(attributes), "city_key", "left")


def city_table(spark: SparkSession, cities=CITIES) -> DataFrame:
    """The city list as a table."""
    return spark.createDataFrame(
        [(c.city_key, c.name, c.official_name, c.lat, c.lon) for c in cities],
        "city_key string, name string, official_name string, lat double, lon double")


def match_station_city(stations: DataFrame, cities=CITIES, column: str = "city") -> DataFrame:
    """One row per station and city it belongs to, adding ``city_key``.

    A city matches when its name occurs in the station's city, or the other way round, or
    when its official name occurs in it; case does not matter. Each row is held against the fixed city list, so
    nothing is shuffled or joined. The list is a literal whose names the planner folds, a station's city is folded once, and
    the comparison is a compiled loop; a lambda over an array would be interpreted for every row and city.
    """
    listed = F.array(*[
        F.struct(F.lit(c.city_key).alias("key"), F.lower(F.lit(c.name)).alias("name"),
                 F.lower(F.lit(c.official_name)).alias("official")) for c in cities])
    against = stations.withColumn("_place", F.lower(F.col(column))).withColumn("_city", F.explode(listed))
    place, name = F.col("_place"), F.col("_city.name")
    belongs = place.contains(name) | name.contains(place) | place.contains(F.col("_city.official"))
    return against.filter(belongs).withColumn("city_key", F.col("_city.key")).drop("_place", "_city")


def first_station(df: DataFrame, order: str = "station_id", key: str = "city_key") -> DataFrame:
    """The first station of each city by ``order``."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = (
        F.pow(F.sin(half_lat), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_lon), 2)
    )
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def nearest_station(
    stations: DataFrame, cities=CITIES, station_id: str = "station_id", lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """city_key, station_id, distance_km of the closest station; the lower id wins a tie.

    Each station is held against the fixed city list by one minimum per city over the whole table. Without a
    grouping key these need no sort (a minimum of structs by key would sort a row per station and city), so a
    task holds its best station of each city and hands on one row.
    """
    place = stations.select(F.col(station_id).alias("station_id"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    known = place.filter(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
    distances = [haversine_km(F.lit(c.lat), F.lit(c.lon), F.col("_lat"), F.col("_lon")) for c in cities]
    best = known.agg(*[
        F.min(F.struct(d.alias("distance_km"), "station_id")).alias(f"_best{i}") for i, d in enumerate(distances)])
    listed = F.array(*[
        F.struct(F.lit(c.city_key).alias("city_key"), F.col(f"_best{i}").alias("best")) for i, c in enumerate(cities)])
    near = best.select(F.explode(listed).alias("_near")).select("_near.*").filter(F.col("best").isNotNull())
    return near.select("city_key", "best.station_id", "best.distance_km")


def _shared(feeds, column: str) -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), [f.select(column) for f in feeds])


def common_cities(weather: DataFrame, air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Cities present in all three feeds."""
    return _shared([f.select("city_key").distinct() for f in (weather, air, traffic)], "city_key")


def common_dates(weather: DataFrame, air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Dates present in all three feeds."""
    dated = [f.select(F.to_date("date").alias("date")).distinct() for f in (weather, air, traffic)]
    return _shared(dated, "date")


def align_cities(
    weather: DataFrame, air: DataFrame, traffic: DataFrame, shared: DataFrame | None = None
) -> tuple[DataFrame, ...]:
    """The three feeds reduced to the cities they share.

    ``shared`` passes the cities in when they are known from somewhere cheaper to read.
    """
    shared = broadcast_if_small(common_cities(weather, air, traffic) if shared is None else shared)
    return tuple(f.join(shared, "city_key", "left_semi") for f in (weather, air, traffic))


def dropped_cities(weather: DataFrame, air: DataFrame, traffic: DataFrame) -> DataFrame:
    """feed, city_key for every city some other feed lacks."""
    shared = common_cities(weather, air, traffic)
    feeds = {"weather": weather, "air_quality": air, "traffic": traffic}
    lost = [
        f.select("city_key").distinct().join(shared, "city_key", "left_anti")
        .select(F.lit(name).alias("feed"), "city_key")
        for name, f in feeds.items()
    ]
    return reduce(DataFrame.unionByName, lost)
