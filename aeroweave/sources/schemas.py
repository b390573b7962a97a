"""Types of the feeds' columns, for reading text without inference."""

from __future__ import annotations

WEATHER_SCHEMA = (
    "datetime timestamp_ntz, temperature double, dwpt double, humidity double, precipitation double, snow double, "
    "wind_direction double, wind_speed double, wpgt double, pressure double, tsun double, weather_code double, "
    "city string, city_key string, lat double, lon double, date date, hour int"
)
AIR_SCHEMA = (
    "city string, city_key string, datetime timestamp_ntz, date date, hour int, station_name string, "
    "station_id string, no2 double, pm10 double, o3 double"
)
TRAFFIC_SCHEMA = (
    "city string, city_key string, datetime timestamp_ntz, date date, hour int, day_of_week int, lat double, "
    "lon double, current_speed double, free_flow_speed double, confidence double, congestion_level double, "
    "traffic_index double, is_rush_hour boolean, is_weekend boolean, is_holiday boolean, holiday_name string, "
    "data_source string"
)
FEED_SCHEMAS = {"weather": WEATHER_SCHEMA, "air_quality": AIR_SCHEMA, "traffic": TRAFFIC_SCHEMA}
