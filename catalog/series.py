"""Grids, rolling means, lags and engineered features."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroweave.operators import features, grids, lags, quality, rolling, units
from catalog.entry import Entry, entry
from catalog.relations import clip, mean_of

LAGGED = ("no2", "pm25", "pm10", "o3", "temperature", "traffic_index")
LAG_NAMES = [f"{c}_lag_{n}h" for c in LAGGED for n in (1, 6, 24)]
LAG_SQL = ", ".join(f"lag({c}, {n}) over w as {c}_lag_{n}h" for c in LAGGED for n in (1, 6, 24))


def _rolling(days: int) -> Entry:
    columns = ("no2", "pm10", "temperature")
    names = [f"{c}_rolling_{days}d" for c in columns]
    # the window is open at its early end: a value exactly N days old is out
    frame = f"range between interval {days * 86400 - 1} second preceding and current row"
    listed = ", ".join(f"avg({c}) over w as {n}" for c, n in zip(columns, names))
    return entry(
        lambda t: rolling.rolling_mean(t.hourly, columns, (days,)).select("city_key", "datetime", *names),
        f"""select city_key, datetime, {listed} from hourly
        window w as (partition by city_key order by datetime {frame})""", "hourly", doubles=" ".join(names))


def _units(table: str, source: str, columns: dict[str, str], run, key: str = "_seq") -> Entry:
    """Columns shifted out of their unit, repaired from the extremes of the whole column."""
    listed = ", ".join(f"{expr} as {c}" for c, expr in columns.items())
    bases = {f"raw_{table}": f"select {key}, {listed} from {source}"}
    rules = {
        "temperature": "case when (select max(temperature) from {r}) > 100 then (temperature - 32) * 5 / 9 else temperature end",
        "wind_speed": "case when (select max(wind_speed) from {r}) > 50 then wind_speed / 3.6 else wind_speed end",
        "pressure": "case when (select min(pressure) from {r}) < 10 then pressure * 1000 "
                    "when (select min(pressure) from {r}) < 100 then pressure * 10 else pressure end",
        "co": "case when (select max(co) from {r}) < 10 then co * 1000 else co end",
        "no2": "case when (select max(no2) from {r}) < 1 then no2 * 1000 else no2 end",
        "pm10": "case when (select max(pm10) from {r}) < 1 then pm10 * 1000 else pm10 end",
        "traffic_index": "case when (select max(traffic_index) from {r}) <= 1 then traffic_index * 100 else traffic_index end",
    }
    body = ", ".join(f"{rules[c].format(r=f'raw_{table}')} as {c}" for c in columns)
    return entry(
        lambda t: run(t.feed(source).select(key, *[F.expr(e).alias(c) for c, e in columns.items()])),
        f"select {key}, {body} from raw_{table}", source, doubles=" ".join(columns), ctes=bases)


HOURLY_COLUMNS = ("no2", "pm10", "o3")


def _first_known(c: str) -> str:
    return f"arg_min({c}, _seq) filter (where {c} is not null) as {c}"


SPAN = "select city_key, min(datetime) as lo, max(datetime) as hi from bronze_air group by city_key"
DAILY_AIR = "bronze_air"


def _hourly_run(t):
    return grids.to_hourly(t.feed("bronze_air").select("city_key", "datetime", "_seq", "station_code", *HOURLY_COLUMNS))


HOURLY_SQL = f"""select g.city_key, g.datetime, coalesce(h.station_code, p.station_code) as station_code,
    {', '.join(f'coalesce(h.{c}, p.{c}) as {c}' for c in HOURLY_COLUMNS)}, cast(g.datetime as date) as date
from (select city_key, unnest(generate_series(lo, hi, interval 1 hour)) as datetime from ({SPAN})) g
left join firsts h on g.city_key = h.city_key and g.datetime = h.datetime
left join firsts p on g.city_key = p.city_key and g.datetime = p.datetime + interval 1 hour"""
FIRSTS = {"firsts": f"""select city_key, datetime, {_first_known('station_code')},
    {', '.join(_first_known(c) for c in HOURLY_COLUMNS)} from bronze_air group by city_key, datetime"""}


def _global_hourly_run(t):
    return grids.to_hourly(t.feed("bronze_traffic").select("datetime", "_seq", "current_speed"), keys=())


GLOBAL_FIRSTS = {"firsts": f"""select datetime, {_first_known('current_speed')} from bronze_traffic group by datetime"""}
GLOBAL_HOURLY_SQL = """select g.datetime, coalesce(h.current_speed, p.current_speed) as current_speed,
    cast(g.datetime as date) as date
from (select unnest(generate_series(lo, hi, interval 1 hour)) as datetime
      from (select min(datetime) as lo, max(datetime) as hi from bronze_traffic)) g
left join firsts h on g.datetime = h.datetime
left join firsts p on g.datetime = p.datetime + interval 1 hour"""


def _daily_run(t):
    rows = t.feed("bronze_weather").select("city_key", "datetime", "_seq", "temperature", "temp_min", "temp_max", "humidity")
    return grids.to_daily(rows)


DAILY_SQL = """select g.city_key, g.date, d.temperature, d.temp_min, d.temp_max, d.humidity,
    cast(g.date as timestamp) as datetime
from (select city_key, cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date from (
        select city_key, cast(min(datetime) as date) as lo, cast(max(datetime) as date) as hi
        from bronze_weather group by city_key)) g
left join (select city_key, cast(datetime as date) as date, avg(temperature) as temperature,
        min(temp_min) as temp_min, max(temp_max) as temp_max, avg(humidity) as humidity
    from bronze_weather group by 1, 2) d on g.city_key = d.city_key and g.date = d.date"""

INDEX_COLUMNS = ("no2", "pm25", "pm10", "o3")


def _share(c: str, relation: str) -> str:
    scaled = f"{c} / nullif((select quantile_cont({c}, 0.95) from {relation}), 0)"
    return clip(f"({scaled})", 0, 1)


def _index_sql(relation: str) -> str:
    return mean_of(*[_share(c, relation) for c in INDEX_COLUMNS])


HIGH = """case when temperature > (select quantile_cont(temperature, 0.75) from {r})
    and traffic_index > (select quantile_cont(traffic_index, 0.75) from {r}) then 1 else 0 end as high_temp_high_traffic"""

AQI_PM25 = """case when pm25 is null then null when pm25 <= 12 then 50 / 12.0 * pm25
    when pm25 <= 35.4 then 50 + 50 / 23.4 * (pm25 - 12) when pm25 <= 55.4 then 100 + 50 / 20.0 * (pm25 - 35.4)
    when pm25 <= 150.4 then 150 + 50 / 95.0 * (pm25 - 55.4) when pm25 <= 250.4 then 200 + 100 / 100.0 * (pm25 - 150.4)
    else 300 + 100 / 249.6 * (pm25 - 250.4) end"""
AQI_PM10 = """case when pm10 is null then null when pm10 <= 54 then 50 / 54.0 * pm10
    when pm10 <= 154 then 50 + 50 / 100.0 * (pm10 - 54) when pm10 <= 254 then 100 + 50 / 100.0 * (pm10 - 154)
    when pm10 <= 354 then 150 + 50 / 100.0 * (pm10 - 254) when pm10 <= 424 then 200 + 100 / 70.0 * (pm10 - 354)
    else 300 + 100 / 180.0 * (pm10 - 424) end"""

FEATURE_DOUBLES = " ".join([
    "no2 pm10 o3 pm25 temperature pressure traffic_index", "hour_sin hour_cos day_of_week_sin day_of_week_cos month_sin month_cos",
    "pollution_index pm25_aqi pm10_aqi pm25_pm10_ratio", "pressure_change pressure_change_rate", *LAG_NAMES,
])
FEATURES_SQL = f"""select city_key, datetime, no2, pm10, o3, pm25, temperature, pressure, traffic_index,
    cast(year(datetime) as integer) as year, cast(month(datetime) as integer) as month,
    cast(day(datetime) as integer) as day, cast(hour(datetime) as integer) as hour,
    cast(isodow(datetime) - 1 as integer) as day_of_week, cast(dayofyear(datetime) as integer) as day_of_year,
    cast(weekofyear(datetime) as integer) as week_of_year,
    sin(2 * pi() * hour(datetime) / 24) as hour_sin, cos(2 * pi() * hour(datetime) / 24) as hour_cos,
    sin(2 * pi() * (isodow(datetime) - 1) / 7) as day_of_week_sin,
    cos(2 * pi() * (isodow(datetime) - 1) / 7) as day_of_week_cos,
    sin(2 * pi() * month(datetime) / 12) as month_sin, cos(2 * pi() * month(datetime) / 12) as month_cos,
    {_index_sql('hourly')} as pollution_index, {AQI_PM25} as pm25_aqi, {AQI_PM10} as pm10_aqi,
    pm25 / (pm10 + 1e-6) as pm25_pm10_ratio,
    {LAG_SQL},
    pressure - lag(pressure) over w as pressure_change,
    (pressure - lag(pressure) over w) / nullif(epoch(datetime) - epoch(lag(datetime) over w), 0) * 3600
        as pressure_change_rate
from hourly window w as (partition by city_key order by datetime)"""


def _lags_sql(columns, lags) -> str:
    listed = ", ".join(f"lag({c}, {n}) over w as {c}_lag_{n}h" for c in columns for n in lags)
    return f"select city_key, datetime, {listed} from hourly window w as (partition by city_key order by datetime)"


def _spine_spans(t):
    return t.read("events").groupBy(F.col("event_type").alias("city_key")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"))


SPINE_SPAN = "(select event_type as city_key, min(ts) as lo, max(ts) as hi from events group by 1)"

ENTRIES: dict[str, Entry] = {
    "hour_spine": entry(
        lambda t: grids.hour_spine(_spine_spans(t)),
        f"""select city_key, unnest(generate_series(date_trunc('hour', lo), hi, interval 1 hour)) as datetime
        from {SPINE_SPAN}"""),
    "date_spine": entry(
        lambda t: grids.date_spine(_spine_spans(t)),
        f"""select city_key, cast(unnest(generate_series(cast(lo as date), cast(hi as date), interval 1 day)) as date)
            as date from {SPINE_SPAN}"""),
    "resample_hourly_first": entry(_hourly_run, HOURLY_SQL, "bronze_air", doubles="no2 pm10 o3", ctes=FIRSTS),
    "resample_hourly_global": entry(_global_hourly_run, GLOBAL_HOURLY_SQL, "bronze_traffic",
                                    doubles="current_speed", ctes=GLOBAL_FIRSTS),
    "resample_daily": entry(_daily_run, DAILY_SQL, "bronze_weather", doubles="temperature temp_min temp_max humidity"),
    "rolling_7d": _rolling(7),
    "rolling_30d": _rolling(30),
    "lag_features": entry(
        lambda t: lags.lag_features(t.hourly.select("city_key", "datetime", "no2", "temperature"), ["no2", "temperature"]),
        f"""select h.*, l.* exclude (city_key, datetime) from (select city_key, datetime, no2, temperature from hourly) h
        join ({_lags_sql(('no2', 'temperature'), (1, 2, 3, 6, 12, 24))}) l
            on h.city_key = l.city_key and h.datetime = l.datetime""", "hourly",
        doubles=" ".join(["no2 temperature"] + [f"{c}_lag_{n}h" for c in ("no2", "temperature") for n in (1, 2, 3, 6, 12, 24)])),
    "pressure_change": entry(
        lambda t: lags.pressure_change(t.hourly.select("city_key", "datetime", "pressure")).drop("pressure_change_rate"),
        """select city_key, datetime, pressure, pressure - lag(pressure) over w as pressure_change from hourly
        window w as (partition by city_key order by datetime)""", "hourly", doubles="pressure pressure_change"),
    "pressure_change_rate": entry(
        lambda t: lags.pressure_change(t.silver_weather.select("city_key", "datetime", "pressure")),
        """select city_key, datetime, pressure, pressure - lag(pressure) over w as pressure_change,
            (pressure - lag(pressure) over w) / nullif(epoch(datetime) - epoch(lag(datetime) over w), 0) * 3600
                as pressure_change_rate
        from silver_weather window w as (partition by city_key order by datetime)""",
        "silver_weather", doubles="pressure pressure_change pressure_change_rate"),
    "temporal_gaps": entry(
        lambda t: quality.temporal_gaps(t.feed("bronze_air")),
        """select city_key, gap_start, gap_end, missing_hours from (
            select city_key, lag(datetime) over w + interval 1 hour as gap_start, datetime - interval 1 hour as gap_end,
                cast((epoch(datetime) - epoch(lag(datetime) over w)) / 3600 - 1 as bigint) as missing_hours
            from (select distinct city_key, datetime from bronze_air)
            window w as (partition by city_key order by datetime)) where missing_hours > 0""", "bronze_air"),
    "pollution_index": entry(
        lambda t: features.pollution_index(t.feed("readings").select("event_id", *INDEX_COLUMNS)).select(
            "event_id", "pollution_index"),
        f"select event_id, {_index_sql('readings')} as pollution_index from readings",
        "readings", doubles="pollution_index"),
    "high_temp_high_traffic": entry(
        lambda t: features.high_temp_high_traffic(t.feed("readings")).select("event_id", "high_temp_high_traffic"),
        f"select event_id, {HIGH.format(r='readings')} from readings", "readings"),
    "interaction_terms": entry(
        lambda t: features.interaction_terms(
            t.feed("readings").select("event_id", "temperature", "traffic_index", "wind_speed", "no2", "pm25", "humidity")
        ).select("event_id", "high_temp_high_traffic", "wind_no2_interaction", "wind_pm25_interaction",
                 "humidity_temp_interaction"),
        f"""select event_id, {HIGH.format(r='readings')}, wind_speed * no2 as wind_no2_interaction,
            wind_speed * pm25 as wind_pm25_interaction, humidity * temperature as humidity_temp_interaction
        from readings""", "readings",
        doubles="wind_no2_interaction wind_pm25_interaction humidity_temp_interaction"),
    "all_features": entry(lambda t: features.all_features(t.hourly), FEATURES_SQL, "hourly", doubles=FEATURE_DOUBLES),
    "standardize_units_weather": _units(
        "weather", "bronze_weather",
        {"temperature": "temperature * 1.8 + 32.0", "wind_speed": "wind_speed * 3.6", "pressure": "pressure / 1000.0"},
        units.standardize_units_weather),
    "standardize_units_air": _units(
        "air", "bronze_air", {"no2": "no2 / 1000.0", "pm10": "pm10", "co": "co"}, units.standardize_units_air),
    "standardize_units_traffic": _units(
        "traffic", "bronze_traffic", {"traffic_index": "congestion_level"}, units.standardize_units_traffic),
}
