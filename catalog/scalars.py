"""Single-value functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroweave.functions import air, binning, calendar, numeric, traffic, weather
from aeroweave.operators import features
from catalog.entry import Entry, entry
from catalog.relations import PERIOD, clip, cut, mean_of, season
from catalog.series import AQI_PM10, AQI_PM25

INF = None
READINGS = "from readings"


def _readings(columns):
    """``columns`` is a function because expressions need a running session."""
    return lambda t: t.feed("readings").select("event_id", *[c.alias(n) for n, c in columns().items()])


def _stamps(columns):
    return lambda t: t.feed("stamps").select("id", *[c.alias(n) for n, c in columns().items()])


def _label(name, column, expression, edges, labels, lowest=False) -> dict[str, Entry]:
    body = f"select event_id, {column}, {cut(column, edges, labels, lowest)} as label {READINGS}"
    run = lambda t: t.feed("readings").select("event_id", column, expression(F.col(column)).alias("label"))
    return {name: entry(run, body, "readings", doubles=column)}



def _hour():
    return F.hour("ts")


def _weekday():
    return F.weekday("ts")


# expected values, written out: the national holidays of 2023 and 2024, and the traffic calendar
HOLIDAYS = """
    (date '2023-01-01', 'Neujahr'), (date '2023-04-07', 'Karfreitag'), (date '2023-04-10', 'Ostermontag'),
    (date '2023-05-01', 'Erster Mai'), (date '2023-05-18', 'Christi Himmelfahrt'), (date '2023-05-29', 'Pfingstmontag'),
    (date '2023-10-03', 'Tag der Deutschen Einheit'), (date '2023-12-25', 'Erster Weihnachtstag'),
    (date '2023-12-26', 'Zweiter Weihnachtstag'),
    (date '2024-01-01', 'Neujahr'), (date '2024-03-29', 'Karfreitag'), (date '2024-04-01', 'Ostermontag'),
    (date '2024-05-01', 'Erster Mai'), (date '2024-05-09', 'Christi Himmelfahrt'), (date '2024-05-20', 'Pfingstmontag'),
    (date '2024-10-03', 'Tag der Deutschen Einheit'), (date '2024-12-25', 'Erster Weihnachtstag'),
    (date '2024-12-26', 'Zweiter Weihnachtstag')"""
TRAFFIC_HOLIDAYS = """
    (date '2024-01-01', 'New Year', true), (date '2024-01-06', 'Epiphany', true), (date '2024-03-29', 'Good Friday', true),
    (date '2024-03-31', 'Easter Sunday', true), (date '2023-12-31', 'Pre-Holiday Travel', false),
    (date '2024-03-28', 'Pre-Holiday Travel', false), (date '2024-03-30', 'Pre-Holiday Travel', false)"""
# events end on 30 January; half of them are moved to late March and early April, where the calendars have most days
MOVED = "case when event_id % 2 = 0 then ts + interval 75 days else ts end"


def _moved(t):
    return t.feed("readings").withColumn(
        "ts", F.when(F.col("event_id") % 2 == 0, F.col("ts") + F.expr("interval 75 days")).otherwise(F.col("ts"))).withColumn(
        "datetime", F.col("ts"))


def _aqi(name, column, expression, expected) -> dict[str, Entry]:
    return {name: entry(
        lambda t: t.feed("readings").select("event_id", column, expression(F.col(column)).alias(name)),
        f"select event_id, {column}, {expected} as {name} {READINGS}",
        "readings", doubles=f"{column} {name}",
    )}


def _holiday_run(t):
    return features.tag_holidays(_moved(t)).select("event_id", "is_holiday", "holiday_name")


def _traffic_holiday_run(t):
    return features.tag_traffic_holidays(_moved(t)).select("event_id", "is_holiday", "is_pre_holiday", "holiday_name")


ENTRIES: dict[str, Entry] = {
    "wind_octant": entry(
        lambda t: t.feed("bronze_weather").select("_seq", weather.wind_octant(F.col("wind_direction") * 2.5 - 100.0).alias("octant")),
        """select _seq, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][1 + ((floor((wind_direction * 2.5 - 100 + 22.5) / 45)::integer % 8 + 8) % 8)]
            as octant from bronze_weather""", "bronze_weather"),
    "calendar_parts": entry(
        _stamps(lambda: calendar.calendar_parts(F.col("ts"))),
        """select id, cast(year(ts) as integer) as year, cast(month(ts) as integer) as month,
            cast(day(ts) as integer) as day, cast(hour(ts) as integer) as hour,
            cast(isodow(ts) - 1 as integer) as day_of_week, cast(dayofyear(ts) as integer) as day_of_year,
            cast(weekofyear(ts) as integer) as week_of_year from stamps""", "stamps"),
    "hour_floor": entry(
        _readings(lambda: dict(hour=calendar.hour_floor(F.col("ts")))),
        "select event_id, date_trunc('hour', ts) as hour from readings", "readings"),
    "to_local_time": entry(
        _stamps(lambda: dict(local=calendar.to_local_time(F.col("ts")))),
        "select id, (ts at time zone 'UTC') at time zone 'Europe/Berlin' as local from stamps", "stamps"),
    "seconds_between": entry(
        _readings(lambda: dict(seconds=calendar.seconds_between(F.col("ts"), F.col("datetime")))),
        "select event_id, epoch_us(ts) / 1e6 - epoch_us(datetime) / 1e6 as seconds from readings",
        "readings", doubles="seconds"),
    "snapshot_name": entry(
        _stamps(lambda: dict(stem=calendar.snapshot_name("weather_data", F.col("ts")))),
        "select id, concat('weather_data_', strftime(ts, '%Y%m%d_%H%M%S')) as stem from stamps", "stamps"),
    "is_night": entry(
        _readings(lambda: dict(is_night=calendar.is_night(_hour()))),
        "select event_id, hour(ts) < 6 or hour(ts) >= 22 as is_night from readings", "readings"),
    "is_weekday": entry(
        _stamps(lambda: dict(is_weekday=calendar.is_weekday(_weekday()))),
        "select id, isodow(ts) <= 5 as is_weekday from stamps", "stamps"),
    "is_weekend": entry(
        _stamps(lambda: dict(is_weekend=calendar.is_weekend(_weekday()))),
        "select id, case when isodow(ts) >= 6 then 1 else 0 end as is_weekend from stamps", "stamps"),
    "day_type": entry(
        _stamps(lambda: dict(day_type=calendar.day_type(calendar.is_weekend(_weekday())))),
        "select id, case when isodow(ts) >= 6 then 'weekend' else 'weekday' end as day_type from stamps", "stamps"),
    "season": entry(
        _stamps(lambda: dict(season=calendar.season(F.month("ts")),
                study_season=calendar.season(F.month("ts"), calendar.STUDY_SEASON_LABELS))),
        f"""select id, {season('month(ts)')} as season,
            {season('month(ts)', ('Winter', 'Spring', 'Summer', 'Fall'))} as study_season from stamps""", "stamps"),
    "rush_hour": entry(
        _readings(lambda: dict(rush_hour=calendar.rush_hour(_hour()))),
        """select event_id, case when hour(ts) in (7, 8, 9) then 'morning' when hour(ts) in (17, 18, 19)
            then 'evening' else 'none' end as rush_hour from readings""", "readings"),
    "is_rush_hour": entry(
        lambda t: features.tag_traffic_holidays(_moved(t)).select(
            "event_id", calendar.is_rush_hour(_hour(), _weekday(), F.col("is_holiday")).alias("is_rush_hour")),
        f"""select event_id, (hour(m) in (7, 8, 9) or hour(m) in (17, 18, 19)) and isodow(m) <= 5
            and not coalesce(h.free, false) as is_rush_hour
        from (select event_id, {MOVED} as m from readings) left join (values {TRAFFIC_HOLIDAYS}) h(d, name, free)
            on cast(m as date) = h.d""", "readings"),
    "time_period": entry(
        _readings(lambda: dict(time_period=calendar.time_period(_hour()))),
        f"select event_id, {PERIOD.format(h='hour(ts)')} as time_period from readings", "readings"),
    "is_rainy": entry(
        _readings(lambda: dict(is_rainy=weather.is_rainy(F.col("precipitation")))),
        "select event_id, precipitation > 0.5 as is_rainy from readings", "readings"),
    "is_holiday": entry(
        _holiday_run,
        f"""select event_id, case when h.d is null then 0 else 1 end as is_holiday, coalesce(h.name, '') as holiday_name
        from (select event_id, {MOVED} as m from readings) left join (values {HOLIDAYS}) h(d, name) on cast(m as date) = h.d""",
        "readings"),
    "holiday_join": entry(
        _traffic_holiday_run,
        f"""select event_id, coalesce(h.free, false) as is_holiday, coalesce(not h.free, false) as is_pre_holiday,
            coalesce(h.name, '') as holiday_name
        from (select event_id, {MOVED} as m from readings) left join (values {TRAFFIC_HOLIDAYS}) h(d, name, free)
            on cast(m as date) = h.d""", "readings"),
    **_label("cut", "steps", lambda c: binning.cut(c, (-10, 0, 25, 50), ("a", "b", "c"), include_lowest=True),
             (-10, 0, 25, 50), ("a", "b", "c"), True),
    **_label("weather_condition", "steps", binning.weather_condition, (INF, 5, 20, INF), ("cold", "mild", "warm")),
    **_label("traffic_level_index", "traffic_index", binning.traffic_level_index,
             (0, 30, 70, 100), ("low", "medium", "high")),
    **_label("temp_category", "steps", binning.temp_category,
             (-50, 0, 10, 20, 50), ("freezing", "cold", "mild", "warm")),
    **_label("air_quality_level", "pm10", binning.air_quality_level,
             (0, 25, 50, 100, 500), ("good", "moderate", "unhealthy", "hazardous")),
    **_label("traffic_level_congestion", "congestion", binning.traffic_level_congestion,
             (0, 0.3, 0.6, 1.0), ("free_flow", "moderate", "congested")),
    **_label("traffic_band", "traffic_index", binning.traffic_band,
             (0, 20, 40, 60, 80, 100), ("free_flow", "light", "moderate", "heavy", "severe"), True),
    "cyclical_encoding": entry(
        _stamps(lambda: calendar.cyclical_encoding(_hour(), _weekday(), F.month("ts"))),
        """select id, sin(2 * pi() * hour(ts) / 24) as hour_sin, cos(2 * pi() * hour(ts) / 24) as hour_cos,
            sin(2 * pi() * (isodow(ts) - 1) / 7) as day_of_week_sin,
            cos(2 * pi() * (isodow(ts) - 1) / 7) as day_of_week_cos,
            sin(2 * pi() * month(ts) / 12) as month_sin, cos(2 * pi() * month(ts) / 12) as month_cos from stamps""",
        "stamps", doubles="hour_sin hour_cos day_of_week_sin day_of_week_cos month_sin month_cos"),
    "heat_index": entry(
        _readings(lambda: dict(heat_index=weather.heat_index(F.col("temperature"), F.col("humidity")))),
        """select event_id, -8.78469475556::double + 1.61139411::double * t + 2.33854883889::double * h
            - 0.14611605::double * t * h - 0.012308094::double * t * t - 0.0164248277778::double * h * h
            + 0.002211732::double * t * t * h + 0.00072546::double * t * h * h
            - 0.000003582::double * t * t * h * h as heat_index
        from (select event_id, temperature as t, humidity as h from readings)""",
        "readings", doubles="heat_index"),
    "wind_chill": entry(
        _readings(lambda: dict(wind_chill=weather.wind_chill(F.col("temperature"), F.col("wind_speed")),
                  wind_chill_kmh=weather.wind_chill(F.col("temperature"), F.col("wind_speed"), "kmh"))),
        """select event_id,
            case when t < 10 and v > 1.33 then 13.12 + 0.6215 * t - 11.37 * pow(v, 0.16) + 0.3965 * t * pow(v, 0.16)
                else t end as wind_chill,
            case when t < 10 and v > 1.33 then 13.12 + 0.6215 * t - 11.37 * pow(3.6 * v, 0.16)
                + 0.3965 * t * pow(3.6 * v, 0.16) else t end as wind_chill_kmh
        from (select event_id, temperature as t, wind_speed as v from readings)""",
        "readings", doubles="wind_chill wind_chill_kmh"),
    "temp_range": entry(
        lambda t: t.feed("bronze_weather").select(
            "_seq", weather.temp_range(F.col("temp_max"), F.col("temp_min")).alias("temp_range")),
        "select _seq, temp_max - temp_min as temp_range from bronze_weather", "bronze_weather", doubles="temp_range"),
    **_aqi("pm25_aqi", "pm25", air.pm25_aqi, AQI_PM25),
    **_aqi("pm10_aqi", "pm10", air.pm10_aqi, AQI_PM10),
    "pm25_pm10_ratio": entry(
        _readings(lambda: dict(ratio=air.pm25_pm10_ratio(F.col("pm25"), F.col("pm10")))),
        "select event_id, pm25 / (pm10 + 1e-6) as ratio from readings", "readings", doubles="ratio"),
    "no2_o3_ratio": entry(
        _readings(lambda: dict(ratio=air.no2_o3_ratio(F.col("no2"), F.col("o3")))),
        "select event_id, no2 / nullif(o3, 0) as ratio from readings", "readings", doubles="ratio"),
    "aqi_avg": entry(
        _readings(lambda: dict(aqi_avg=air.aqi_avg([F.col("no2"), F.col("pm10"), F.col("o3")]))),
        f"select event_id, {mean_of('no2', 'pm10', 'o3')} as aqi_avg from readings", "readings", doubles="aqi_avg"),
    "row_mean": entry(
        _readings(lambda: dict(mean=numeric.row_mean([F.col("no2"), F.col("pm25"), F.col("temperature")]))),
        f"select event_id, {mean_of('no2', 'pm25', 'temperature')} as mean from readings", "readings", doubles="mean"),
    "clip_range": entry(
        _readings(lambda: dict(clamped=numeric.clip_range(F.col("temperature"), 0, 50), raised=numeric.clip_range(F.col("steps"), 5))),
        f"select event_id, {clip('temperature', 0, 50)} as clamped, {clip("steps", 5)} as raised from readings",
        "readings", doubles="clamped raised"),
    "round_to": entry(
        _readings(lambda: dict(one=numeric.round_to(F.col("wind_speed") + 0.013, 1),
                  three=numeric.round_to(F.col("no2") / 7, 3))),
        "select event_id, round(wind_speed + 0.013, 1) as one, round(no2 / 7, 3) as three from readings", "readings"),
    "congestion_metrics": entry(
        _readings(lambda: dict(
            congestion_level=traffic.congestion_level(F.col("current_speed"), F.col("free_flow_speed")),
            traffic_index=traffic.traffic_index(F.col("current_speed"), F.col("free_flow_speed")),
            speed=traffic.speed_at(F.col("free_flow_speed"), F.col("congestion")),
        )),
        """select event_id,
            case when current_speed <> 0 and free_flow_speed <> 0 then 1 - current_speed / free_flow_speed end
                as congestion_level,
            case when current_speed <> 0 and free_flow_speed <> 0 then (1 - current_speed / free_flow_speed) * 100 end
                as traffic_index,
            greatest(10.0, free_flow_speed * (1 - 0.7 * congestion)) as speed from readings""",
        "readings", doubles="congestion_level traffic_index speed"),
    "exceedance_flags": entry(
        _readings(lambda: {f"{c}_exceeds": air.exceeds(F.col(c), v) for c, v in (("no2", 200), ("pm10", 50), ("o3", 110))}),
        """select event_id, case when no2 > 200 then 1 else 0 end as no2_exceeds,
            case when pm10 > 50 then 1 else 0 end as pm10_exceeds,
            case when o3 > 110 then 1 else 0 end as o3_exceeds from readings""", "readings"),
}
