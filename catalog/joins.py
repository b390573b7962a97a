"""Merges, city matching and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroweave.dims import CITIES, city_aliases
from aeroweave.operators import cities, features, merge
from catalog.entry import Entry, entry
from catalog.relations import season

GOLD_DOUBLES = ("temperature humidity precipitation wind_speed wind_direction pressure lat lon weather_code no2 pm10 o3 aqi_avg "
                "current_speed free_flow_speed congestion_level traffic_index")
STUDY_DOUBLES = ("no2 pm10 o3 temperature temp_min temp_max wind_speed precipitation pressure wpgt traffic_index "
                 "congestion_level current_speed temp_range")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CITY_ROWS = ", ".join(
    f"({_quoted(c.city_key)}, {_quoted(c.name)}, {_quoted(c.official_name)}, {c.lat!r}::double, {c.lon!r}::double)"
    for c in CITIES
)
DIM_CITY = {"dim_city": f"select * from (values {CITY_ROWS}) v(city_key, name, official_name, lat, lon)"}
ALIASES = {"aliases": "select * from (values "
           + ", ".join(f"({_quoted(a)}, {_quoted(k)})" for a, k in city_aliases().items()) + ") v(spelling, city_key)"}


def _merged(how: str):
    def run(t):
        weather, air, traffic = t.silver
        parts = (
            weather.select("city_key", "datetime", "temperature", "hour", F.col("city_key").alias("city")),
            air.select("city_key", "datetime", "no2", "hour", F.col("city_key").alias("city")),
            traffic.select("city_key", "datetime", "traffic_index", "hour", F.col("city_key").alias("city")),
        )
        return merge.merge_feeds(*parts, how=how)
    return run


def _merge_sql(how: str) -> str:
    join = {"outer": "full outer", "inner": "inner", "left": "left", "right": "right"}[how]
    return f"""select coalesce(m.city_key, t.city_key) as city_key, coalesce(m.datetime, t.datetime) as datetime,
        m.temperature, m.hour, m.city, m.no2, m.hour_aq, m.datetime_aq, t.traffic_index, t.hour as hour_traffic,
        t.datetime as datetime_traffic
    from (
        select coalesce(w.city_key, a.city_key) as city_key, coalesce(w.datetime, a.datetime) as datetime,
            w.temperature, w.hour, w.city_key as city, a.no2, a.hour as hour_aq,
            a.datetime as datetime_aq
        from silver_weather w {join} join silver_air a on w.city_key = a.city_key and w.datetime = a.datetime
    ) m {join} join silver_traffic t on m.city_key = t.city_key and m.datetime = t.datetime"""


def _aligned(t):
    names = ("weather", "air_quality", "traffic")
    aligned = cities.align_cities(*t.bronze)
    return merge.union_feeds([
        df.select("city_key", "_seq", F.lit(name).alias("feed")) for name, df in zip(names, aligned)
    ])


FEED_CITIES = {"weather": "bronze_weather", "air_quality": "bronze_air", "traffic": "bronze_traffic"}
COMMON = " intersect ".join(f"select city_key from {r}" for r in FEED_CITIES.values())
BRONZE = tuple(FEED_CITIES.values())


def _long(t):
    """Pollutant readings in long form."""
    return t.feed("bronze_air").select(
        "city_key", "datetime", F.explode(F.array(
            F.struct(F.lit("NO2").alias("pollutant"), F.col("no2").alias("value")),
            F.struct(F.lit("PM10").alias("pollutant"), F.col("pm10").alias("value")),
            F.struct(F.lit("O3").alias("pollutant"), F.col("o3").alias("value")),
        )).alias("p")).select("city_key", "datetime", "p.*")


def _one_pollutant(t, column: str):
    rows = t.feed("bronze_air").filter(F.col(column).isNotNull())
    return rows.groupBy("city_key", "datetime").agg(F.avg(column).alias(column))


MATCHED = """(select s.station_id, d.city_key from stations s join dim_city d on
    contains(lower(s.city), lower(d.name)) or contains(lower(d.name), lower(s.city))
    or contains(lower(s.city), lower(d.official_name)))"""

HAVERSINE = """2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(s.lat - d.lat) / 2), 2)
    + cos(radians(d.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - d.lon) / 2), 2))))"""

NAMED_CITIES = """case event_id % 6 when 0 then 'Köln' when 1 then ' MÜNCHEN ' when 2 then 'Frankfurt am Main'
    when 3 then 'Düsseldorf' when 4 then ' Luebeck' else 'Atlantis' end"""

ENTRIES: dict[str, Entry] = {
    "gold_merge": entry(lambda t: merge.gold_merge(*t.silver), "select * from gold_base", "gold_base",
                        doubles=GOLD_DOUBLES),
    "gold_features": entry(lambda t: t.gold, "select * from gold", "gold", doubles=GOLD_DOUBLES),
    **{
        f"merge_{how}": entry(_merged(how), _merge_sql(how), "silver_weather", "silver_air", "silver_traffic",
                              doubles="temperature no2 traffic_index")
        for how in ("inner", "outer", "left", "right")
    },
    "merge_prepare": entry(
        lambda t: merge.merge_prepare(
            t.read("events").select("event_id", F.col("ts").alias("datetime"), F.expr(NAMED_CITIES).alias("city"))),
        f"""select event_id, ts as datetime, city, coalesce(a.city_key, lower(trim(city))) as city_key,
            date_trunc('hour', ts) as datetime_hour
        from (select event_id, ts, {NAMED_CITIES} as city from events) e
        left join aliases a on lower(trim(e.city)) = a.spelling""", ctes=ALIASES),
    "standardize_city": entry(
        lambda t: cities.standardize_city(t.read("events").select("event_id", F.expr(NAMED_CITIES).alias("city"))),
        f"""select event_id, city, coalesce(a.city_key, lower(trim(city))) as city_key
        from (select event_id, {NAMED_CITIES} as city from events) e
        left join aliases a on lower(trim(e.city)) = a.spelling""", ctes=ALIASES),
    "city_alias_join": entry(
        lambda t: cities.standardize_city(
            t.feed("bronze_weather").select("_seq", F.col("city_key").alias("city")),
            t.feed("bronze_weather").select("city_key").distinct().select(
                F.upper("city_key").alias("city_key"), F.array("city_key").alias("name_variations"))),
        "select _seq, city_key as city, upper(city_key) as city_key from bronze_weather", "bronze_weather"),
    "daily_study_merge": entry(lambda t: t.study, "select * from study", "study", doubles=STUDY_DOUBLES),
    "pollutant_outer_merge": entry(
        lambda t: merge.merge_pollutants([_one_pollutant(t, c) for c in ("no2", "pm10", "o3")]),
        """select * from (
            select city_key, datetime, avg(no2) as no2, avg(pm10) as pm10, avg(o3) as o3 from bronze_air group by 1, 2)
        where no2 is not null or pm10 is not null or o3 is not null""", "bronze_air", doubles="no2 pm10 o3"),
    "pivot_pollutants": entry(
        lambda t: merge.pivot_pollutants(_long(t)),
        """select * from (
            select city_key, datetime, avg(no2) as no2, avg(pm10) as pm10, avg(o3) as o3 from bronze_air group by 1, 2)
        where no2 is not null or pm10 is not null or o3 is not null""", "bronze_air", doubles="no2 pm10 o3"),
    "station_to_city_hour": entry(
        lambda t: merge.station_to_city_hour(merge.merge_prepare(t.feed("bronze_air"))),
        """select city_key, datetime as datetime_hour, avg(no2) as no2, avg(pm25) as pm25, avg(pm10) as pm10,
            avg(o3) as o3, avg(co) as co from bronze_air group by 1, 2""",
        "bronze_air", doubles="no2 pm25 pm10 o3 co"),
    "air_daily_mean": entry(
        lambda t: merge.air_daily(t.shipments), "select * from study_air", "study_air", doubles="no2 pm10 o3"),
    "align_cities": entry(
        _aligned,
        " union all ".join(
            f"select city_key, _seq, '{feed}' as feed from {r} where city_key in ({COMMON})"
            for feed, r in FEED_CITIES.items()), *BRONZE),
    "dropped_cities": entry(
        lambda t: cities.dropped_cities(*t.bronze),
        " union all ".join(
            f"select distinct '{feed}' as feed, city_key from {r} where city_key not in ({COMMON})"
            for feed, r in FEED_CITIES.items()), *BRONZE),
    "common_cities": entry(lambda t: cities.common_cities(*t.bronze), COMMON, *BRONZE),
    "common_dates": entry(
        lambda t: cities.common_dates(*(df.withColumn("date", F.to_date("datetime")) for df in t.bronze)),
        " intersect ".join(f"select cast(datetime as date) as date from {r}" for r in BRONZE), *BRONZE),
    "union_feeds": entry(
        lambda t: merge.union_feeds([df.select("city_key", "_seq", *extra) for df, extra in zip(
            t.bronze, (["humidity"], ["o3"], ["congestion_level"]))]),
        """select city_key, _seq, humidity, null::double as o3, null::double as congestion_level from bronze_weather
        union all select city_key, _seq, null, o3, null from bronze_air
        union all select city_key, _seq, null, null, congestion_level from bronze_traffic""", *BRONZE,
        doubles="humidity o3 congestion_level"),
    "sort_city_time": entry(
        lambda t: merge.sort_city_time(t.feed("bronze_weather").select("city_key", "datetime", "_seq"), total=True),
        "select city_key, datetime, _seq from bronze_weather order by city_key, datetime", "bronze_weather"),
    "match_station_city": entry(
        lambda t: cities.match_station_city(t.feed("stations")).select("station_id", "city_key"),
        f"select station_id, city_key from {MATCHED}", "stations", ctes=DIM_CITY),
    "first_station": entry(
        lambda t: cities.first_station(cities.match_station_city(t.feed("stations"))).select("city_key", "station_id"),
        f"select city_key, min(station_id) as station_id from {MATCHED} group by city_key", "stations", ctes=DIM_CITY),
    "nearest_station": entry(
        lambda t: cities.nearest_station(t.feed("stations")),
        f"""select city_key, station_id, distance_km from (
            select d.city_key, s.station_id, {HAVERSINE} as distance_km from stations s cross join dim_city d)
        qualify row_number() over (partition by city_key order by distance_km, station_id) = 1""",
        "stations", doubles="distance_km", ctes=DIM_CITY),
    "transform_categories": entry(
        lambda t: features.transform_categories(t.gold.select("city_key", "datetime", "temperature", "traffic_index")),
        f"""select city_key, datetime, temperature, traffic_index,
            cast(isodow(datetime) - 1 as integer) as day_of_week, cast(month(datetime) as integer) as month,
            cast(hour(datetime) as integer) as hour, case when isodow(datetime) >= 6 then 1 else 0 end as is_weekend,
            case when isodow(datetime) >= 6 then 'weekend' else 'weekday' end as day_type,
            {season('month(datetime)')} as season,
            case when hour(datetime) in (7, 8, 9) then 'morning' when hour(datetime) in (17, 18, 19) then 'evening'
                else 'none' end as rush_hour,
            case when temperature <= 5 then 'cold' when temperature <= 20 then 'mild'
                when temperature > 20 then 'warm' end as weather_condition,
            case when traffic_index <= 0 then null when traffic_index <= 30 then 'low'
                when traffic_index <= 70 then 'medium' when traffic_index <= 100 then 'high' end as traffic_level,
            case when cast(datetime as date) = date '2024-01-01' then 1 else 0 end as is_holiday
        from gold""", "gold", doubles="temperature traffic_index"),
}
