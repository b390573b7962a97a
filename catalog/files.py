"""Readers, writers and payloads."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.operators import fills, merge
from aeroweave.session import ensure_checkpoint_dir
from aeroweave.sources import feeds, payloads, readers, writers
from catalog.cleaning import SILVER_TRAFFIC
from catalog.entry import Entry, entry

EVENT_COLUMNS = ("event_id", "ts", "event_type", "value")
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, event_type string, value double"
FEED_DOUBLES = ("temperature humidity wind_speed precipitation pressure wind_direction snow wpgt tsun temp_min temp_max lat lon "
                "weather_code "
                "current_speed free_flow_speed confidence congestion_level traffic_index")
EVENTS_SQL = "select event_id, ts, event_type, value from events"


def _folder(t) -> str:
    """A new shared folder for the files of one run."""
    return f"{ensure_checkpoint_dir(t.spark)}/aeroweave-{uuid4().hex}"


def _events(t) -> DataFrame:
    return t.read("events").select(*EVENT_COLUMNS)


def _written(t, fmt: str) -> str:
    path = f"{_folder(t)}/events.{fmt}"
    writers.save(_events(t), path, fmt)
    return path


def _json_array(t) -> str:
    """Files holding one JSON array of records each: ten thousand events to an array."""
    path = f"{_folder(t)}/events.json"
    block = F.floor(F.col("event_id") / 10_000).alias("block")
    arrays = _events(t).groupBy(block).agg(F.to_json(F.collect_list(F.struct(*EVENT_COLUMNS)), {"timestampNTZFormat": writers.TEXT_TIMES}).alias("text"))
    arrays.write.partitionBy("block").text(path)
    return path


def _latest(t) -> DataFrame:
    folder = f"{_folder(t)}/weather"
    events = _events(t)
    for name, rows in (("weather_data_20240101_000000", events.withColumn("value", -F.col("value"))),
                       ("weather_data_20240102_000000", events),
                       ("other_20240103_000000", events.select("event_id"))):
        writers.save(rows, f"{folder}/{name}.parquet")
    return readers.latest(t.spark, folder, "weather_data_*")


def _load_feeds(t) -> DataFrame:
    folder = _folder(t)
    weather, _, traffic = t.bronze
    writers.save(weather, f"{folder}/weather.parquet")
    writers.save(traffic, f"{folder}/traffic.parquet")
    loaded = readers.load_feeds(t.spark, {
        "weather": f"{folder}/weather.parquet",
        "air_quality": f"{folder}/air_quality.csv",
        "traffic": f"{folder}/traffic.parquet",
    })
    return merge.union_feeds([df.withColumn("feed", F.lit(name)) for name, df in loaded.items()])


def _dual(t) -> DataFrame:
    base = f"{_folder(t)}/silver"
    writers.save_dual(merge.sort_city_time(t.silver_traffic), base)
    parquet = readers.scan_parquet(t.spark, f"{base}.parquet").withColumn("copy", F.lit("parquet"))
    kinds = ", ".join(f"{c} {kind}" for c, kind in parquet.drop("copy").dtypes)
    csv = readers.scan_csv(t.spark, f"{base}.csv", kinds).fillna("").withColumn("copy", F.lit("csv"))
    return parquet.unionByName(csv)


def _source_order(t) -> DataFrame:
    """Events written in time order, read back, and the first of each kind and day by its place in the files."""
    rows = t.read("events").select("event_id", "event_type", F.to_date("ts").alias("day"), "value", "ts").orderBy("ts", "event_id").drop("ts")
    kinds, found = "event_id bigint, event_type string, day date, value double", []
    for fmt in ("parquet", "csv"):
        path = f"{_folder(t)}/ordered.{fmt}"
        writers.save(rows, path, fmt)
        read = readers.load(t.spark, path, kinds, source_order=True)
        found.append(fills.dedupe_keep_first(read, ("event_type", "day")).drop("_seq").withColumn("format", F.lit(fmt)))
    return merge.union_feeds(found)


def _air_from_payloads(t) -> DataFrame:
    stations = t.read("customer").selectExpr(f"{STATION_PAYLOAD} as payload")
    return payloads.air_from_payloads(stations, t.read("events").selectExpr(f"{MEASUREMENT_PAYLOAD} as payload"))


def _by_city(t) -> DataFrame:
    path = f"{_folder(t)}/cities"
    writers.save_by_city(t.feed("bronze_weather").select("city_key", "_seq", "humidity"), path)
    return readers.scan_parquet(t.spark, path)


STATION_CSV = {
    "DatetimeBegin": "case when event_id % 10 = 0 then 'unknown' else cast(date_trunc('second', ts) as string) end",
    "AirQualityStation": "event_type",
    "AirQualityStationEoICode": "concat('DE', cast(user_id as string))",
    "NO2": "value",
    "PM2.5": "value / 2.0",
    "Value": "case when event_id % 3 = 0 then null else value end",
    "Concentration": "value + 1.0",
    "UnitOfMeasurement": "'µg/m3'",
}


def _station_csv(t) -> DataFrame:
    return t.read("events").selectExpr("event_id", *[f"{e} as `{c}`" for c, e in STATION_CSV.items()])


STATION_SQL = """select event_id, case when event_id % 10 <> 0 then date_trunc('second', ts) end as datetime,
    event_type as station_name, concat('DE', cast(user_id as varchar)) as station_code, value as no2,
    value / 2.0 as pm25, 'µg/m3' as unit,
    coalesce(case when event_id % 3 = 0 then null else value end, value + 1.0) as value,
    {city} as city, {key} as city_key,
    case when event_id % 10 <> 0 then cast(ts as date) end as date,
    case when event_id % 10 <> 0 then cast(hour(ts) as integer) end as hour
from events"""


def _many_csv(t) -> DataFrame:
    folder = _folder(t)
    rows = _station_csv(t)
    for key in ("berlin", "munich", "atlantis"):
        writers.save(rows, f"{folder}/{key}.csv", "csv")
    stacked = feeds.import_many_csv(t.spark, {k: f"{folder}/{k}.csv" for k in ("berlin", "munich", "atlantis")})
    return stacked.withColumn("event_id", F.col("event_id").cast("bigint"))


STATION_PAYLOAD = """concat('{"data":{"', cast(c_custkey as string), '":["', cast(c_custkey as string),
    '","DE', cast(c_nationkey as string), '","Station ', c_mktsegment, '","Berlin","BE","2001-01-01",null,"13.4"',
    case when c_custkey % 5 = 0 then '' else concat(',"', cast(c_acctbal as string), '",1,2') end, ']}}')"""

MEASUREMENT_PAYLOAD = """concat('{"data":{"', cast(user_id as string), '":{"',
    date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '":["', date_format(ts, 'yyyy-MM-dd HH:59:59'), '",1,0',
    case when event_id % 10 = 0 then '' else concat(
        case when event_id % 6 = 0 then ',[5.0,' else ',[5,' end, case when event_id % 7 = 0 then 'null' else cast(value as string) end, ',0,"1"],[5,999.0,0,"2"]') end,
    case when event_id % 4 = 0 then ',[1,20,0,"1"]' else '' end,
    case when event_id % 9 = 0 then ',[3]' else '' end, ']}}}')"""

MEASUREMENT_SQL = """select * from (
    select cast(user_id as varchar) as station_id, date_trunc('second', ts) as datetime,
        date_trunc('hour', ts) + interval 3599 second as datetime_end, 'NO2' as component, value
    from events where event_id % 10 <> 0 and event_id % 7 <> 0
    union all
    select cast(user_id as varchar), date_trunc('second', ts), date_trunc('hour', ts) + interval 3599 second,
        'PM10', 20.0 from events where event_id % 4 = 0)"""

FLOW_PAYLOAD = """concat('{"flowSegmentData":{"currentSpeed":', cast(event_id % 40 as string), ',"freeFlowSpeed":',
    cast(40 + event_id % 11 as string), ',"confidence":0.99}}')"""


def _weather_source(t) -> DataFrame:
    return t.read("events").selectExpr(
        "event_id", "event_type as city_key", "ts as time", "value / 4.0 as temp", "cast(event_id % 90 as double) as wspd",
        "cast(event_id % 101 as double) as rhum", "cast(event_id % 27 as double) as coco")


def _places(t) -> DataFrame:
    return t.read("events").groupBy(F.col("event_type").alias("city_key")).agg(
        F.upper(F.first("event_type")).alias("name"), F.lit(52.5).alias("lat"), F.lit(13.4).alias("lon"))


ENTRIES: dict[str, Entry] = {
    "scan_csv": entry(lambda t: readers.scan_csv(t.spark, _written(t, "csv"), EVENT_SCHEMA), EVENTS_SQL, doubles="value"),
    "scan_parquet": entry(
        lambda t: readers.scan_parquet(t.spark, f"{t.sf_dir}/events.parquet"), "select * from events", doubles="value"),
    "scan_json_records": entry(
        lambda t: readers.scan_json(t.spark, _json_array(t), EVENT_SCHEMA).drop("block"), EVENTS_SQL, doubles="value"),
    "scan_by_extension": entry(
        lambda t: readers.load(t.spark, f"{t.sf_dir}/nation.parquet"), "select * from nation"),
    "latest_snapshot": entry(_latest, EVENTS_SQL, doubles="value"),
    "load_feeds": entry(
        _load_feeds,
        """select *, 'weather' as feed from bronze_weather
        union all by name select *, 'traffic' as feed from bronze_traffic""", "bronze_weather", "bronze_traffic",
        doubles=FEED_DOUBLES),
    "sink_parquet": entry(lambda t: readers.load(t.spark, _written(t, "parquet")), EVENTS_SQL, doubles="value"),
    "sink_csv": entry(lambda t: readers.load(t.spark, _written(t, "csv"), EVENT_SCHEMA), EVENTS_SQL, doubles="value"),
    "sink_json": entry(
        lambda t: t.spark.read.schema(EVENT_SCHEMA).json(_written(t, "json")), EVENTS_SQL, doubles="value"),
    "sink_dual": entry(
        _dual,
        """select * replace (cast(date as varchar) as date)
        from silver_traffic cross join (values ('parquet'), ('csv')) c(copy)""",
        "silver_traffic", doubles=SILVER_TRAFFIC),
    "source_order": entry(
        _source_order,
        """select event_id, event_type, day, value, f.format from (
            select event_id, event_type, cast(ts as date) as day, value from events
            qualify row_number() over (partition by event_type, cast(ts as date) order by ts, event_id) = 1)
        cross join (values ('parquet'), ('csv')) f(format)""", doubles="value"),
    "air_from_payloads": entry(
        _air_from_payloads,
        f"""with s as (select cast(c_custkey as varchar) as station_id, concat('Station ', c_mktsegment) as station_name
                from customer where c_custkey % 5 <> 0 order by cast(c_custkey as varchar) limit 1),
            m as ({MEASUREMENT_SQL})
        select 'Berlin' as city, 'berlin' as city_key, datetime, cast(datetime as date) as date,
            cast(hour(datetime) as integer) as hour, station_name, station_id,
            avg(value) filter (where component = 'NO2') as no2, avg(value) filter (where component = 'PM10') as pm10,
            null::double as o3
        from m join s using (station_id) group by datetime, station_name, station_id""", doubles="no2 pm10 o3"),
    "sink_by_city": entry(
        _by_city, "select city_key, _seq, humidity from bronze_weather", "bronze_weather", doubles="humidity"),
    "import_station_csv": entry(
        lambda t: feeds.import_station_csv(_station_csv(t), "munich"),
        STATION_SQL.format(city="'Munich'", key="'munich'"), doubles="no2 pm25 value"),
    "import_many_csv": entry(
        _many_csv,
        " union all ".join(STATION_SQL.format(city=f"'{name}'", key=f"'{name.lower()}'") for name in ("Berlin", "Munich")),
        doubles="no2 pm25 value"),
    "flatten_stations": entry(
        lambda t: payloads.flatten_stations(t.read("customer").selectExpr(f"{STATION_PAYLOAD} as payload")).withColumn(
            "latitude", F.col("latitude").cast("double")),
        """select cast(c_custkey as varchar) as station_id, concat('DE', cast(c_nationkey as varchar)) as station_code,
            concat('Station ', c_mktsegment) as station_name, 'Berlin' as city, 'BE' as state_code,
            '2001-01-01' as date_from, null::varchar as date_to, '13.4' as longitude, c_acctbal as latitude
        from customer where c_custkey % 5 <> 0""", doubles="latitude"),
    "flatten_measurements": entry(
        lambda t: payloads.flatten_measurements(t.read("events").selectExpr(f"{MEASUREMENT_PAYLOAD} as payload")),
        MEASUREMENT_SQL, doubles="value"),
    "normalize_weather": entry(
        lambda t: feeds.normalize_weather(_weather_source(t), _places(t)),
        """select event_id, event_type as city_key, ts as datetime, value / 4.0 as temperature,
            (event_id % 90) / 3.6 as wind_speed, cast(event_id % 101 as double) as humidity,
            cast(event_id % 27 as double) as weather_code, cast(ts as date) as date,
            cast(hour(ts) as integer) as hour, upper(event_type) as city, 52.5::double as lat, 13.4::double as lon
        from events""", doubles="temperature wind_speed humidity weather_code"),
    "normalize_traffic_flow": entry(
        lambda t: payloads.normalize_traffic_flow(t.read("events").selectExpr("event_id", f"{FLOW_PAYLOAD} as payload")),
        """select event_id, cast(event_id % 40 as double) as current_speed,
            cast(40 + event_id % 11 as double) as free_flow_speed, 0.99::double as confidence,
            case when event_id % 40 <> 0 then 1 - (event_id % 40)::double / (40 + event_id % 11) end as congestion_level,
            case when event_id % 40 <> 0 then 100 * (1 - (event_id % 40)::double / (40 + event_id % 11)) end as traffic_index
        from events""", doubles="current_speed free_flow_speed confidence congestion_level traffic_index"),
}
