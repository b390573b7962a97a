"""The end-to-end jobs, with every column of what they write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.weather import HEAT_INDEX
from aeroweave.operators import merge
from aeroweave.plans import medallion
from catalog.cleaning import SHARED, SILVER_AIR, SILVER_TRAFFIC, SILVER_WEATHER
from catalog.entry import Entry, entry
from catalog.files import _folder
from catalog.joins import GOLD_DOUBLES
from catalog.relations import mean_of, season
from catalog.series import AQI_PM10, AQI_PM25, _share
from catalog.study import (
    MATRIX_SQL, RANGE_SQL, READING_COLUMNS, SCATTER_TESTS_SQL, SUMMARY_SQL, TESTS_SQL, UNIT_SQL, _iqr_sql, _null_sql,
    _regression_sql, _statistics_sql,
)

SILVER = (("weather", "silver_weather"), ("air_quality", "silver_air"), ("traffic", "silver_traffic"))


def _silver(t) -> dict[str, DataFrame]:
    return medallion.build_silver(t.spark, dict(zip(medallion.FEEDS, t.bronze)), f"{_folder(t)}/silver")


def _silver_job(t) -> DataFrame:
    return merge.union_feeds([df.withColumn("feed", F.lit(name)) for name, df in _silver(t).items()])


def _gold_job(t) -> DataFrame:
    return medallion.build_gold(_silver(t), f"{_folder(t)}/gold")


def _final_job(t) -> DataFrame:
    """From raw feeds to the table that reports are made from."""
    return medallion.build_final(_silver(t))


def _study_job(t) -> DataFrame:
    """The tables of the study as one: table, a, b (names), value, n."""
    found = medallion.run_study(t.spark, dict(zip(medallion.STUDY_FEEDS, t.study_feeds)), _folder(t))
    none = F.lit(None)
    parts = [
        found["correlations"].select(F.lit("correlations").alias("table"), F.col("x").alias("a"), F.col("y").alias("b"), F.col("r").alias("value"), "n"),
        *[found[name].select(F.lit(f"{name}_{c}").alias("table"), F.col("pollutant").alias("a"), F.col("predictor").alias("b"),
                             F.col(c).alias("value"), "n") for name in ("tests", "scatter_tests") for c in ("correlation", "p_value")],
        *[found["regression"].select(F.lit(f"regression_{c}").alias("table"), F.col("pollutant").alias("a"), F.col("term").alias("b"),
                                     F.col(c).alias("value"), "n") for c in ("coefficient", "r2")],
        found["summary"].select(F.lit("summary").alias("table"), F.col("item").alias("a"), F.col("value").alias("b"),
                                none.cast("double").alias("value"), none.cast("bigint").alias("n")),
        found["merged"].select(F.lit("merged").alias("table"), F.col("city").alias("a"), F.col("date").cast("string").alias("b"),
                               F.col("no2").alias("value"), none.cast("bigint").alias("n")),
    ]
    return merge.union_feeds(parts)


def _quality_job(t) -> DataFrame:
    """The report as one long table: table, measure, item, value."""
    found = medallion.run_quality(t.feed("readings").select(*READING_COLUMNS), _folder(t), READING_COLUMNS)
    parts = []
    for name, df in found.items():
        measure = "column" if name == "nulls" else "measure"
        items = [c for c in df.columns if c not in (measure, "unit")]
        numbers = df.select(F.col(measure).alias("measure"), *[F.col(c).cast("double").alias(c) for c in items])
        parts.append(numbers.unpivot("measure", items, "item", "value").filter("value is not null").withColumn("table", F.lit(name)))
    return merge.union_feeds(parts)


def _long(name: str, sql: str, measure: str = "measure") -> str:
    drop = f"{measure}, unit" if "'unit'" in sql or " as unit" in sql else measure
    return f"""select '{name}' as "table", measure, item, value from (
        unpivot (select {measure} as measure, columns(* exclude ({drop}))::double from ({sql}))
        on columns(* exclude (measure)) into name item value value)"""


QUALITY_SQL = " union all ".join([
    _long("ranges", RANGE_SQL), _long("units", UNIT_SQL), _long("nulls", _null_sql(READING_COLUMNS), '"column"'),
    _long("statistics", _statistics_sql()), _long("outliers", _iqr_sql()),
])

STUDY_SQL = " union all ".join([
    f"select 'correlations' as table, x as a, y as b, r as value, n from ({MATRIX_SQL})",
    *[f"select '{name}_{c}', pollutant, predictor, {c}, n from ({sql})"
      for name, sql in (("tests", TESTS_SQL), ("scatter_tests", SCATTER_TESTS_SQL)) for c in ("correlation", "p_value")],
    *[f"select 'regression_{c}', pollutant, term, {c}, n from ({_regression_sql()})" for c in ("coefficient", "r2")],
    f"select 'summary', item, value, null, null from ({SUMMARY_SQL})",
    "select 'merged', city, cast(date as varchar), no2, null from study",
])

_BY_COLUMN = {
    "temperature": "case when (select max(temperature) from {r}) > 100 then (temperature - 32) * 5 / 9 else temperature end",
    "wind_speed": "case when (select max(wind_speed) from {r}) > 50 then wind_speed / 3.6 else wind_speed end",
    "pressure": "case when (select min(pressure) from {r}) < 10 then pressure * 1000 "
                "when (select min(pressure) from {r}) < 100 then pressure * 10 else pressure end",
    "co": "case when (select max(co) from {r}) < 10 then co * 1000 else co end",
    **{c: f"case when (select max({c}) from {{r}}) < 1 then {c} * 1000 else {c} end" for c in ("no2", "pm25", "pm10", "o3")},
    "traffic_index": "case when (select max(traffic_index) from {r}) <= 1 then traffic_index * 100 else traffic_index end",
}
_WEATHER = ("temperature humidity wind_speed precipitation pressure wind_direction snow tsun temp_min temp_max city lat lon "
            "weather_code hour is_night is_weekday").split()
_AIR = "no2 pm25 pm10 o3 co".split()
_TRAFFIC = "is_rush_hour holiday_name traffic_index congestion_level current_speed free_flow_speed hour is_night is_weekday".split()
# columns that weather and traffic both have
_TWICE = "date hour is_night is_weekday day_of_week month is_weekend day_type season rush_hour is_holiday".split()
_LOCAL = "((datetime at time zone 'UTC') at time zone 'Europe/Berlin')"


def _hourly(silver: str, columns, units) -> str:
    """Shared cities in standard units, on a grid whose gaps of one hour take the hour before."""
    kept = f"(select * from {silver} where city_key in {SHARED})"
    standard = ", ".join(f"{_BY_COLUMN[c].format(r=kept)} as {c}" for c in units)
    found = f"(select * replace ({standard}) from {kept})"
    listed = ", ".join(f"coalesce(h.{c}, p.{c}) as {c}" for c in columns)
    return f"""select g.city_key, g.datetime, {listed}, cast(g.datetime as date) as date
        from (select city_key, unnest(generate_series(lo, hi, interval 1 hour)) as datetime from (
            select city_key, min(datetime) as lo, max(datetime) as hi from {kept} group by city_key)) g
        left join {found} h on g.city_key = h.city_key and g.datetime = h.datetime
        left join {found} p on g.city_key = p.city_key and g.datetime = p.datetime + interval 1 hour"""


def _categories(relation: str, also: str) -> str:
    return f"""select *, cast(isodow({_LOCAL}) - 1 as integer) as day_of_week, cast(month({_LOCAL}) as integer) as month,
        case when isodow({_LOCAL}) >= 6 then 1 else 0 end as is_weekend,
        case when isodow({_LOCAL}) >= 6 then 'weekend' else 'weekday' end as day_type, {season(f'month({_LOCAL})')} as season,
        case when hour in (7, 8, 9) then 'morning' when hour in (17, 18, 19) then 'evening' else 'none' end as rush_hour, {also},
        case when cast({_LOCAL} as date) = date '2024-01-01' then 1 else 0 end as is_holiday from {relation}"""


_CONDITION = """case when temperature <= 5 then 'cold' when temperature <= 20 then 'mild' when temperature > 20 then 'warm' end
    as weather_condition"""
_LEVEL = """case when traffic_index <= 0 then null when traffic_index <= 30 then 'low' when traffic_index <= 70 then 'medium'
    when traffic_index <= 100 then 'high' end as traffic_level"""
_ROLLED = ("no2", "pm25", "pm10", "o3", "temperature", "traffic_index")
FINAL_CTES = {
    "weather_hours": _hourly("silver_weather", _WEATHER, ("temperature", "wind_speed", "pressure")),
    "air_hours": _hourly("silver_air", _AIR, _AIR),
    "traffic_hours": _hourly("silver_traffic", _TRAFFIC, ("traffic_index",)),
    "weather_final": _categories("weather_hours", _CONDITION),
    "traffic_final": _categories("traffic_hours", _LEVEL),
    "merged": f"""select coalesce(m.city_key, t.city_key) as city_key, coalesce(m.datetime, t.datetime) as datetime,
        m.* exclude (city_key, datetime), t.* exclude (city_key, datetime, {', '.join(_TWICE)}),
        {', '.join(f't.{c} as {c}_traffic' for c in ('datetime', *_TWICE))}
    from (select coalesce(w.city_key, a.city_key) as city_key, coalesce(w.datetime, a.datetime) as datetime,
            w.* exclude (city_key, datetime), a.* exclude (city_key, datetime, date)
        from weather_final w full join air_hours a on w.city_key = a.city_key and w.datetime = a.datetime) m
    full join traffic_final t on m.city_key = t.city_key and m.datetime = t.datetime""",
    "rolled": f"""select *, {', '.join(f'avg({c}) over w{n} as {c}_rolling_{n}d' for c in _ROLLED for n in (7, 30))} from merged window
        {', '.join(f"w{n} as (partition by city_key order by datetime range between interval {n * 86400 - 1} second preceding and current row)"
                   for n in (7, 30))}""",
}
_HEAT = " + ".join(
    " * ".join([repr(weight), *["temperature"] * t, *["humidity"] * h]) for (t, h), weight in HEAT_INDEX.items())
_LAGGED = [f"{c}_lag_{n}h" for c in _ROLLED for n in (1, 6, 24)]
FINAL_SQL = f"""select * exclude (hour, month, day_of_week), {_LOCAL} as local_datetime,
    case when temperature > (select quantile_cont(temperature, 0.75) from rolled)
        and traffic_index > (select quantile_cont(traffic_index, 0.75) from rolled) then 1 else 0 end as high_temp_high_traffic,
    wind_speed * no2 as wind_no2_interaction, wind_speed * pm25 as wind_pm25_interaction, humidity * temperature as humidity_temp_interaction,
    {', '.join(f"cast({f}({_LOCAL}) as integer) as {name}" for f, name in (
        ('year', 'year'), ('month', 'month'), ('day', 'day'), ('hour', 'hour'), ('dayofyear', 'day_of_year'), ('weekofyear', 'week_of_year')))},
    cast(isodow({_LOCAL}) - 1 as integer) as day_of_week,
    {', '.join(f"{f}(2 * pi() * {value} / {period}) as {name}_{f}" for f in ('sin', 'cos') for name, value, period in (
        ('hour', f'hour({_LOCAL})', 24), ('day_of_week', f'(isodow({_LOCAL}) - 1)', 7), ('month', f'month({_LOCAL})', 12)))},
    {_HEAT} as heat_index,
    case when temperature < 10 and wind_speed > 1.33 then 13.12 + 0.6215 * temperature - 11.37 * pow(wind_speed, 0.16)
        + 0.3965 * temperature * pow(wind_speed, 0.16) else temperature end as wind_chill,
    temp_max - temp_min as temp_range,
    {mean_of(*[_share(c, 'rolled') for c in ('no2', 'pm25', 'pm10', 'o3')])} as pollution_index,
    {AQI_PM25} as pm25_aqi, {AQI_PM10} as pm10_aqi, pm25 / (pm10 + 1e-6) as pm25_pm10_ratio,
    {', '.join(f'lag({c}, {n}) over w as {c}_lag_{n}h' for c in _ROLLED for n in (1, 6, 24))},
    pressure - lag(pressure) over w as pressure_change,
    (pressure - lag(pressure) over w) / nullif(epoch(datetime) - epoch(lag(datetime) over w), 0) * 3600 as pressure_change_rate
from rolled window w as (partition by city_key order by datetime)"""
FINAL_DOUBLES = " ".join([
    "temperature humidity wind_speed precipitation pressure wind_direction snow tsun temp_min temp_max lat lon weather_code no2 pm25 pm10 o3 co",
    "traffic_index congestion_level current_speed free_flow_speed wind_no2_interaction wind_pm25_interaction humidity_temp_interaction",
    "hour_sin hour_cos day_of_week_sin day_of_week_cos month_sin month_cos heat_index wind_chill temp_range pollution_index pm25_aqi pm10_aqi",
    "pm25_pm10_ratio pressure_change pressure_change_rate", *[f"{c}_rolling_{n}d" for c in _ROLLED for n in (7, 30)], *_LAGGED])

ENTRIES: dict[str, Entry] = {
    "final_job": entry(_final_job, FINAL_SQL, "silver_weather", "silver_air", "silver_traffic", doubles=FINAL_DOUBLES, ctes=FINAL_CTES),
    "silver_job": entry(
        _silver_job,
        " union all by name ".join(
            f"select * replace (cast(date as varchar) as date), '{name}' as feed from {relation} where city_key in {SHARED}"
            for name, relation in SILVER),
        "silver_weather", "silver_air", "silver_traffic", doubles=f"{SILVER_WEATHER} {SILVER_AIR} {SILVER_TRAFFIC}"),
    "gold_job": entry(
        _gold_job, "select * replace (cast(date as varchar) as date) from gold", "gold", doubles=GOLD_DOUBLES),
    "quality_job": entry(_quality_job, QUALITY_SQL, "readings", doubles="value"),
    "study_job": entry(_study_job, STUDY_SQL, "study", doubles="value"),
}
