"""The shared tables once more in plain SQL, written the straightforward way."""

from __future__ import annotations

from catalog.bindings import FEEDS, MEASURES, SHIPMENTS, duck_feed


def r6(expr: str) -> str:
    """Six digits, moved off exact ties so that sums added in another order agree."""
    return f"round({expr} + 1.37e-9, 6)"


def fill(column: str, order: str = "datetime, _seq", key: str = "city_key") -> str:
    """Last known value up to the row, else the first known one after it."""
    over = f"partition by {key} order by {order}"
    return (
        f"coalesce(last_value({column} ignore nulls) over ({over} rows between unbounded preceding and current row), "
        f"first_value({column} ignore nulls) over ({over} rows between current row and unbounded following))"
    )


def clip(column: str, lo=None, hi=None) -> str:
    tests = []
    if lo is not None:
        tests.append(f"when {column} < {lo} then {lo}")
    if hi is not None:
        tests.append(f"when {column} > {hi} then {hi}")
    return f"cast(case {' '.join(tests)} else {column} end as double)"


def cut(column: str, edges, labels, lowest: bool = False) -> str:
    tests = []
    for lo, hi, label in zip(edges, edges[1:], labels):
        low = "true" if lo is None else f"{column} {'>=' if lowest and lo == edges[0] else '>'} {lo}"
        high = "true" if hi is None else f"{column} <= {hi}"
        tests.append(f"when {column} is not null and {low} and {high} then '{label}'")
    return f"case {' '.join(tests)} end"


def mean_of(*columns: str) -> str:
    total = " + ".join(f"coalesce({c}, 0)" for c in columns)
    known = " + ".join(f"(case when {c} is null then 0 else 1 end)" for c in columns)
    return f"(({total}) / nullif({known}, 0))"


def first_rows(relation: str) -> str:
    return (
        f"(select * from {relation} qualify row_number() over "
        "(partition by city_key, datetime order by _seq) = 1)"
    )


CALENDAR = """cast(datetime as date) as date, cast(hour(datetime) as integer) as hour,
    cast(month(datetime) as integer) as month, (hour(datetime) < 6 or hour(datetime) >= 22) as is_night,
    cast(isodow(datetime) - 1 as integer) as day_of_week, (isodow(datetime) - 1 < 5) as is_weekday"""

WEATHER_CARRIED = ("temperature", "humidity", "wind_speed", "precipitation", "pressure", "wind_direction",
                   "temp_min", "temp_max", "city", "lat", "lon", "weather_code")
TRAFFIC_CARRIED = ("current_speed", "free_flow_speed", "congestion_level", "traffic_index")

SEASON = """case when {m} in (12, 1, 2) then '{0}' when {m} in (3, 4, 5) then '{1}'
    when {m} in (6, 7, 8) then '{2}' else '{3}' end"""


def season(month: str, labels=("winter", "spring", "summer", "autumn")) -> str:
    return SEASON.format(*labels, m=month)


PERIOD = """case when {h} between 6 and 9 then 'morning_rush' when {h} between 10 and 15 then 'midday'
    when {h} between 16 and 19 then 'evening_rush' when {h} between 20 and 22 then 'evening' else 'night' end"""

GOLD_LEVELS = {
    "temp_category": ("temperature", (-50, 0, 10, 20, 50), ("freezing", "cold", "mild", "warm")),
    "air_quality_level": ("aqi_avg", (0, 25, 50, 100, 500), ("good", "moderate", "unhealthy", "hazardous")),
    "traffic_level": ("congestion_level", (0, 0.3, 0.6, 1.0), ("free_flow", "moderate", "congested")),
}

RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    **{name: ((), duck_feed(name)) for name in (*FEEDS, *SHIPMENTS)},
    "filled_weather": (("bronze_weather",), f"""
        select city_key, datetime, _seq, {', '.join(f'{fill(c)} as {c}' for c in WEATHER_CARRIED)},
            coalesce(snow, 0) as snow,
            coalesce(tsun, (select quantile_cont(tsun, 0.5) from bronze_weather)) as tsun
        from bronze_weather"""),
    "first_weather": (("filled_weather",), f"select * from {first_rows('filled_weather')}"),
    "silver_weather": (("first_weather",), f"""
        select city_key, datetime, {clip('temperature', -40, 50)} as temperature,
            {clip('humidity', 0, 100)} as humidity, {clip('wind_speed', 0, 50)} as wind_speed,
            {clip('precipitation', 0)} as precipitation, pressure, wind_direction, snow, tsun, temp_min, temp_max,
            city, lat, lon, weather_code,
            {CALENDAR}
        from first_weather"""),
    "filled_air": (("bronze_air",), f"""
        select city_key, datetime, _seq, station_code,
            {', '.join(f'coalesce({fill(c)}, 0) as {c}' for c in ('no2', 'pm10', 'o3'))},
            coalesce(pm25, 0) as pm25, coalesce(co, 0) as co
        from bronze_air"""),
    "first_air": (("filled_air",), f"select * from {first_rows('filled_air')}"),
    "silver_air": (("first_air",), f"""
        select *, {mean_of('no2', 'pm10', 'o3')} as aqi_avg, {CALENDAR} from (
            select city_key, datetime, station_code,
                {', '.join(f'{clip(c, 0, 500)} as {c}' for c in ('no2', 'pm10', 'o3'))}, pm25, co
            from first_air)"""),
    "filled_traffic": (("bronze_traffic",), f"""
        select city_key, datetime, _seq, coalesce(is_rush_hour, true) as is_rush_hour, coalesce(is_weekend, true) as is_weekend,
            is_holiday, coalesce(holiday_name, '') as holiday_name,
            {', '.join(f'coalesce({fill(c)}, 0) as {c}' for c in TRAFFIC_CARRIED)}
        from bronze_traffic"""),
    "first_traffic": (("filled_traffic",), f"select * from {first_rows('filled_traffic')}"),
    "silver_traffic": (("first_traffic",), f"""
        select city_key, datetime, is_rush_hour, is_weekend, is_holiday, holiday_name, {clip('traffic_index', 0, 100)} as traffic_index,
            {clip('congestion_level', 0, 1)} as congestion_level, {clip('current_speed', 0, 200)} as current_speed,
            {clip('free_flow_speed', 0, 200)} as free_flow_speed, {CALENDAR}
        from first_traffic"""),
    "gold_base": (("silver_weather", "silver_air", "silver_traffic"), """
        select w.city_key, w.datetime, w.temperature, w.humidity, w.precipitation, w.wind_speed, w.wind_direction,
            w.pressure, w.city, w.lat, w.lon, w.weather_code, w.date, w.hour, w.month, w.day_of_week, w.is_night, w.is_weekday,
            a.no2, a.pm10, a.o3, a.aqi_avg,
            t.current_speed, t.free_flow_speed, t.congestion_level, t.traffic_index, t.is_rush_hour, t.is_weekend,
            t.is_holiday, t.holiday_name
        from silver_weather w
        join silver_air a on w.city_key = a.city_key and w.datetime = a.datetime
        join silver_traffic t on w.city_key = t.city_key and w.datetime = t.datetime"""),
    "gold": (("gold_base",), f"""
        select *, {PERIOD.format(h='hour')} as time_period, {season('month')} as season,
            precipitation > 0.5 as is_rainy,
            {', '.join(f'{cut(*args)} as {name}' for name, args in GOLD_LEVELS.items())}
        from gold_base"""),
    "hourly": (("shipments",), f"""
        select city_key, datetime, {', '.join(f'avg({c}) as {c}' for c in MEASURES)}
        from shipments group by city_key, datetime"""),
    "study_air": (("shipments",), """
        select city, date, avg(no2) as no2, avg(pm10) as pm10, avg(o3) as o3 from shipments group by city, date"""),
    "study_weather": (("shipments",), """
        select city, date, avg(temperature) as temperature, avg(temperature - 4.0) as temp_min,
            avg(temperature + 5.0) as temp_max, avg(pm25) as wind_speed, avg(o3) as precipitation,
            avg(pressure) as pressure, avg(no2) as wpgt
        from shipments group by city, date"""),
    "study_traffic": (("shipments",), """
        select city, next_date as date, avg(traffic_index) as traffic_index, avg(traffic_index / 100.0) as congestion_level,
            avg(no2) as current_speed
        from shipments group by city, next_date"""),
    "study": (("study_air", "study_weather", "study_traffic"), f"""
        select a.city, a.date, a.no2, a.pm10, a.o3, w.temperature, w.temp_min, w.temp_max, w.wind_speed,
            w.precipitation, w.pressure, w.wpgt, t.traffic_index, t.congestion_level, t.current_speed,
            w.temp_max - w.temp_min as temp_range, cast(month(a.date) as integer) as month,
            cast(isodow(a.date) - 1 as integer) as day_of_week,
            case when isodow(a.date) >= 6 then 1 else 0 end as is_weekend,
            {season('month(a.date)', ('Winter', 'Spring', 'Summer', 'Fall'))} as season
        from study_air a
        join study_weather w on a.city = w.city and a.date = w.date
        join study_traffic t on a.city = t.city and a.date = t.date"""),
}


def _needed(names, found: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in found:
            needs, text = RELATIONS[name]
            _needed(needs, found)
            found[name] = text
    return found


def query(body: str, *relations: str, doubles: str = "", ctes: dict[str, str] | None = None) -> str:
    """A full statement: the relations it needs, then the body, doubles rounded."""
    parts = _needed(relations, {}) | (ctes or {})
    columns = doubles.split()
    if columns:
        body = f"select * replace ({', '.join(f'{r6(c)} as {c}' for c in columns)}) from (\n{body}\n)"
    if not parts:
        return body
    listed = ",\n".join(f"{name} as (\n{text}\n)" for name, text in parts.items())
    return f"with {listed}\n{body}"
