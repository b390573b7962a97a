"""What each column of the final table means."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

NO_DESCRIPTION = "Variable description not available"

# Column name and its description
DESCRIPTIONS = {
    "city": "City name",
    "city_key": "Standardized city identifier, one of 79 German cities",
    "datetime": "Timestamp in UTC",
    "date": "Date (YYYY-MM-DD)",
    "temperature": "Temperature in degrees Celsius (°C)",
    "temp_min": "Minimum temperature in degrees Celsius (°C)",
    "temp_max": "Maximum temperature in degrees Celsius (°C)",
    "feels_like": "Feels like temperature in degrees Celsius (°C)",
    "humidity": "Relative humidity as percentage (%)",
    "pressure": "Atmospheric pressure in hectopascals (hPa)",
    "wind_speed": "Wind speed in meters per second (m/s)",
    "wind_direction": "Wind direction in degrees (0-360)",
    "clouds": "Cloud coverage percentage (%)",
    "visibility": "Visibility in meters (m)",
    "rain_1h": "Rainfall in last 1 hour in millimeters (mm)",
    "rain_3h": "Rainfall in last 3 hours in millimeters (mm)",
    "snow_1h": "Snowfall in last 1 hour in millimeters (mm)",
    "weather_main": "Main weather condition (e.g., Clear, Clouds, Rain)",
    "weather_description": "Detailed weather description",
    "no2": "Nitrogen dioxide concentration in micrograms per cubic meter (μg/m³)",
    "pm25": "PM2.5 (particulate matter < 2.5μm) concentration in micrograms per cubic meter (μg/m³)",
    "pm10": "PM10 (particulate matter < 10μm) concentration in micrograms per cubic meter (μg/m³)",
    "o3": "Ozone concentration in micrograms per cubic meter (μg/m³)",
    "co": "Carbon monoxide concentration in micrograms per cubic meter (μg/m³)",
    "station_code": "Air quality monitoring station code",
    "station_name": "Air quality monitoring station name",
    "traffic_index": "Traffic congestion index (0-100, where 100 = maximum congestion)",
    "congestion_level": "Traffic congestion level (0-1, where 1 = maximum congestion)",
    "current_speed": "Current traffic speed in km/h",
    "free_flow_speed": "Free flow speed in km/h",
    "confidence": "Confidence level of traffic data",
    "year": "Year",
    "month": "Month (1-12)",
    "day": "Day of month (1-31)",
    "hour": "Hour of day (0-23)",
    "day_of_week": "Day of week (0=Monday, 6=Sunday)",
    "day_of_year": "Day of year (1-365/366)",
    "week_of_year": "Week of year (1-52/53)",
    "is_weekend": "Binary indicator for weekend (1=weekend, 0=weekday)",
    "day_type": "Day type category (weekday/weekend)",
    "season": "Season (winter/spring/summer/autumn)",
    "is_holiday": "Binary indicator for German public holiday (1=holiday, 0=not holiday)",
    "weather_condition": "Weather condition category (cold/mild/warm)",
    "heat_index": "Heat index (feels like temperature considering humidity)",
    "wind_chill": "Wind chill temperature",
    "temp_range": "Temperature range (max - min)",
    "pressure_change": "Change in atmospheric pressure",
    "pressure_change_rate": "Rate of pressure change per hour",
    "traffic_level": "Traffic level category (low/medium/high)",
    "rush_hour": "Rush hour indicator (morning/evening/none)",
    "pm25_aqi": "PM2.5 Air Quality Index (US EPA scale)",
    "pm10_aqi": "PM10 Air Quality Index (US EPA scale)",
    "pollution_index": "Combined pollution index (normalized 0-1)",
    "pm25_pm10_ratio": "Ratio of PM2.5 to PM10",
    "high_temp_high_traffic": "Binary indicator for high temperature and high traffic",
    "wind_no2_interaction": "Interaction term: wind speed × NO2",
    "wind_pm25_interaction": "Interaction term: wind speed × PM2.5",
    "humidity_temp_interaction": "Interaction term: humidity × temperature",
    "hour_sin": "Cyclical encoding of hour (sine component)",
    "hour_cos": "Cyclical encoding of hour (cosine component)",
    "day_of_week_sin": "Cyclical encoding of day of week (sine component)",
    "day_of_week_cos": "Cyclical encoding of day of week (cosine component)",
    "month_sin": "Cyclical encoding of month (sine component)",
    "month_cos": "Cyclical encoding of month (cosine component)",
}

# Rolling means and lags follow a naming rule, so their texts do too
_ROLLING = {"no2": "NO2", "pm25": "PM2.5", "pm10": "PM10", "o3": "O3",
            "temperature": "temperature", "traffic_index": "traffic index"}
_LAGGED = {"no2": "NO2 value", "pm25": "PM2.5 value", "pm10": "PM10 value", "o3": "O3 value",
           "temperature": "Temperature", "traffic_index": "Traffic index"}

for _column, _label in _ROLLING.items():
    for _days in (7, 30):
        DESCRIPTIONS[f"{_column}_rolling_{_days}d"] = f"{_days}-day rolling average of {_label}"
for _column, _label in _LAGGED.items():
    for _hours in (1, 6, 24):
        _unit = "hour" if _hours == 1 else "hours"
        DESCRIPTIONS[f"{_column}_lag_{_hours}h"] = f"{_label} {_hours} {_unit} ago"


def dim_description(spark: SparkSession) -> DataFrame:
    """column_name, description."""
    return spark.createDataFrame(pa.table({
        "column_name": list(DESCRIPTIONS), "description": list(DESCRIPTIONS.values()),
    }))
