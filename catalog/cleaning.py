"""Schema repair and bronze-to-silver cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroweave.operators import clean, fills, merge, schema
from catalog.entry import Entry, entry
from catalog.relations import fill, first_rows

SILVER_WEATHER = ("temperature humidity wind_speed precipitation pressure wind_direction snow tsun temp_min temp_max lat lon "
                  "weather_code")
SILVER_AIR = "no2 pm10 o3 pm25 co aqi_avg"
SILVER_TRAFFIC = "traffic_index congestion_level current_speed free_flow_speed"


def _nulls(relation: str, *columns: str) -> str:
    return " + ".join(f"(select count(*) - count({c}) from {relation})" for c in columns)


def _beyond(relation: str, *tests: str) -> str:
    return " + ".join(f"(select count(*) from {relation} where {t})" for t in tests)


def _metrics(feed: str, bronze: str, first: str, filled: str, dropped: str, counted: str, clipped: str) -> str:
    return f"""select '{feed}' as feed, (select count(*) from {bronze}) as rows_before,
        (select count(*) from {first}) as rows_after,
        (select count(*) from {bronze}) - (select count(*) from {first}) as duplicates_removed,
        cast({filled} as bigint) as nulls_filled, cast({dropped} as bigint) as nulls_dropped,
        cast({counted} as bigint) as outliers_clipped, cast({clipped} as bigint) as values_clipped"""


def _outside(column: str, lo, hi) -> str:
    return f"{column} < {lo} or {column} > {hi}"


WEATHER_COUNTED = ["temperature < -40 or temperature > 50", "humidity < 0 or humidity > 100", "wind_speed < 0",
                   "precipitation < 0"]
WEATHER_CLIPPED = [*WEATHER_COUNTED[:2], _outside("wind_speed", 0, 50), "precipitation < 0"]
AIR_COUNTED = [_outside(c, 0, 500) for c in ("no2", "pm10", "o3")]
TRAFFIC_COUNTED = [_outside("traffic_index", 0, 100), _outside("congestion_level", 0, 1), "current_speed < 0",
                   "free_flow_speed < 0"]
TRAFFIC_CLIPPED = [*TRAFFIC_COUNTED[:2], _outside("current_speed", 0, 200), _outside("free_flow_speed", 0, 200)]

METRICS_SQL = " union all ".join([
    _metrics("weather", "bronze_weather", "first_weather",
             _nulls("bronze_weather", "temperature", "pressure", "snow", "tsun", "lon"), _nulls("bronze_weather", "wpgt"),
             _beyond("first_weather", *WEATHER_COUNTED), _beyond("first_weather", *WEATHER_CLIPPED)),
    _metrics("air_quality", "bronze_air", "first_air", _nulls("bronze_air", "no2", "pm10", "o3", "pm25", "co"), "0",
             _beyond("first_air", *AIR_COUNTED), _beyond("first_air", *AIR_COUNTED)),
    _metrics("traffic", "bronze_traffic", "first_traffic",
             _nulls("bronze_traffic", "current_speed", "holiday_name"), "0",
             _beyond("first_traffic", *TRAFFIC_COUNTED), _beyond("first_traffic", *TRAFFIC_CLIPPED)),
])

CASTS = {"event_id": "string", "user_id": "double", "ts": "timestamp_ntz", "value": "double", "props": "int"}
SHARED = """(select city_key from silver_weather intersect select city_key from silver_air
    intersect select city_key from silver_traffic)"""


def _clean_all(t):
    feeds = zip(("weather", "air_quality", "traffic"), clean.clean_all(*t.bronze))
    return merge.union_feeds([df.withColumn("feed", F.lit(name)) for name, df in feeds])


ENTRIES: dict[str, Entry] = {
    "select_available": entry(
        lambda t: schema.select_available(t.feed("bronze_weather"), ["city_key", "datetime", "_seq", "humidity", "absent"]),
        "select city_key, datetime, _seq, humidity from bronze_weather", "bronze_weather", doubles="humidity"),
    "drop_columns": entry(
        lambda t: schema.drop_columns(t.read("events"), ["props", "value", "absent"]),
        "select event_id, ts, user_id, event_type from events"),
    "rename_columns": entry(
        lambda t: schema.rename_columns(t.read("events").select("event_id", "event_type"), {"event_type": "city"}),
        "select event_id, event_type as city from events"),
    "filter_city": entry(
        lambda t: schema.filter_city(t.feed("bronze_weather"), "click_1").select("_seq", "humidity"),
        "select _seq, humidity from bronze_weather where city_key = 'click_1'", "bronze_weather", doubles="humidity"),
    "filter_in_set": entry(
        lambda t: schema.filter_in_set(t.feed("bronze_weather"), t.feed("bronze_air")).select("city_key", "_seq"),
        "select city_key, _seq from bronze_weather where city_key in (select city_key from bronze_air)",
        "bronze_weather", "bronze_air"),
    "constant_columns": entry(
        lambda t: schema.constant_columns(t.read("events").select("event_id"), {"city": "Berlin", "zone": 1}),
        "select event_id, 'Berlin' as city, 1 as zone from events"),
    "drop_incomplete": entry(
        lambda t: schema.complete_cases(t.feed("bronze_air"), ["no2", "pm10"]).select("_seq", "no2", "pm10", "pm25"),
        "select _seq, no2, pm10, pm25 from bronze_air where no2 is not null and pm10 is not null",
        "bronze_air", doubles="no2 pm10 pm25"),
    "drop_sparse_columns": entry(
        lambda t: schema.drop_sparse_columns(t.feed("bronze_weather"), ["wpgt", "tsun", "dwpt"]),
        """select * exclude (wpgt, tsun), coalesce(tsun, (select quantile_cont(tsun, 0.5) from bronze_weather)) as tsun
        from bronze_weather""", "bronze_weather",
        doubles=SILVER_WEATHER),
    "median_fill": entry(
        lambda t: schema.median_fill(t.feed("bronze_air").select("_seq", "no2", "pm10"), ["no2", "pm10"]),
        """select _seq, coalesce(no2, (select quantile_cont(no2, 0.5) from bronze_air)) as no2,
            coalesce(pm10, (select quantile_cont(pm10, 0.5) from bronze_air)) as pm10 from bronze_air""",
        "bronze_air", doubles="no2 pm10"),
    "fill_zero": entry(
        lambda t: schema.fill_zero(t.feed("bronze_air").select("_seq", "no2", "station_code")),
        "select _seq, coalesce(no2, 0) as no2, station_code from bronze_air", "bronze_air", doubles="no2"),
    "cast_feed": entry(
        lambda t: schema.cast_feed(t.feed("bronze_traffic"), "traffic").select(
            "_seq", "datetime", "date", "hour", "day_of_week", "is_holiday"),
        """select _seq, datetime, cast(datetime as date) as date, cast(hour(datetime) as integer) as hour,
            cast(isodow(datetime) - 1 as integer) as day_of_week, is_holiday from bronze_traffic""", "bronze_traffic"),
    "coerce_types": entry(
        lambda t: schema.coerce_types(t.read("events"), CASTS),
        """select cast(event_id as varchar) as event_id, ts, cast(user_id as double) as user_id, event_type, value,
            try_cast(props as integer) as props from events""", doubles="value"),
    "float_downcast": entry(
        lambda t: schema.float_downcast(t.feed("bronze_air").select("_seq", "o3", "co")).select(
            "_seq", F.col("o3").cast("double").alias("o3"), F.col("co").cast("double").alias("co")),
        "select _seq, cast(cast(o3 as float) as double) as o3, cast(cast(co as float) as double) as co from bronze_air",
        "bronze_air", doubles="o3 co"),
    "objects_to_string": entry(
        lambda t: schema.objects_to_string(
            t.read("events").select("event_id", F.to_date("ts").alias("date"), F.array("event_type").alias("tags"))),
        """select event_id, cast(cast(ts as date) as varchar) as date, concat('["', event_type, '"]') as tags
        from events"""),
    "ensure_datetime": entry(
        lambda t: schema.ensure_datetime(t.read("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))),
        """select o_orderkey, cast(o_orderdate as date) as date, cast(cast(o_orderdate as date) as timestamp) as datetime
        from orders"""),
    "dedupe_keep_first": entry(
        lambda t: fills.dedupe_keep_first(t.feed("bronze_weather")).select("city_key", "datetime", "_seq", "humidity"),
        f"select city_key, datetime, _seq, humidity from {first_rows('bronze_weather')}",
        "bronze_weather", doubles="humidity"),
    "fill_forward_back": entry(
        lambda t: fills.fill_ffill_bfill(t.feed("bronze_air"), ["no2", "pm10"]).select("_seq", "no2", "pm10"),
        f"select _seq, {fill('no2')} as no2, {fill('pm10')} as pm10 from bronze_air",
        "bronze_air", doubles="no2 pm10"),
    "fill_forward_limit1": entry(
        lambda t: fills.fill_forward_limit1(t.feed("bronze_air"), ["no2", "pm10"]).select("_seq", "no2", "pm10"),
        """select _seq, coalesce(no2, lag(no2) over w) as no2, coalesce(pm10, lag(pm10) over w) as pm10
        from bronze_air window w as (partition by city_key order by datetime, _seq)""",
        "bronze_air", doubles="no2 pm10"),
    "clean_weather": entry(lambda t: t.silver_weather, "select * from silver_weather", "silver_weather",
                           doubles=SILVER_WEATHER),
    "clean_air_quality": entry(lambda t: t.silver_air, "select * from silver_air", "silver_air", doubles=SILVER_AIR),
    "clean_traffic": entry(lambda t: t.silver_traffic, "select * from silver_traffic", "silver_traffic",
                           doubles=SILVER_TRAFFIC),
    "clean_metrics": entry(
        lambda t: merge.union_feeds([
            clean.clean_metrics(df, feed) for df, feed in zip(t.bronze, ("weather", "air_quality", "traffic"))]),
        METRICS_SQL, "first_weather", "first_air", "first_traffic"),
    "clean_all": entry(
        _clean_all,
        " union all by name ".join(
            f"""select *, '{name}' as feed from {relation} where city_key in {SHARED}"""
            for name, relation in (("weather", "silver_weather"), ("air_quality", "silver_air"),
                                   ("traffic", "silver_traffic"))),
        "silver_weather", "silver_air", "silver_traffic", doubles=f"{SILVER_WEATHER} {SILVER_AIR} {SILVER_TRAFFIC}"),
}
