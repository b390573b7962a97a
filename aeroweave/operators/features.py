"""Feature tables: categories, gold features, and the full engineered set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.dims import dim_holiday, dim_traffic_holiday
from aeroweave.dims.holidays import PRE_HOLIDAY_NAME
from aeroweave.functions import air, binning, calendar, weather
from aeroweave.functions.numeric import clip_range, row_mean
from aeroweave.operators.lags import pressure_and_lags
from aeroweave.operators.rolling import rolling_mean
from aeroweave.operators.schema import ensure_datetime
from aeroweave.plans.chunks import TARGET_ROWS, measure_density
from aeroweave.plans.quantiles import exact_quantiles, quantile_name
from aeroweave.plans.shared import written
from aeroweave.plans.small import attach_scalars, broadcast_if_small

INDEX_POLLUTANTS = ("no2", "pm25", "pm10", "o3")
LAG_COLUMNS = (*INDEX_POLLUTANTS, "temperature", "traffic_index")
PIPELINE_LAGS = (1, 6, 24)
INDEX_QUANTILE = 0.95
HIGH_QUANTILE = 0.75


def tag_holidays(df: DataFrame, holidays: DataFrame | None = None, ts: str = "datetime") -> DataFrame:
    """Add ``is_holiday`` (0/1) and ``holiday_name`` (empty on other days) by date.

    The built-in calendar has nine rows a year; a caller's own is broadcast only if small.
    """
    given = holidays is not None
    days = (holidays if given else dim_holiday(df.sparkSession)).select(
        F.col("date").alias("_day"), F.col("name").alias("_holiday")
    )
    if given:
        days = broadcast_if_small(days.groupBy("_day").agg(F.min("_holiday").alias("_holiday")))
    else:
        days = F.broadcast(days)
    tagged = df.drop("is_holiday", "holiday_name").join(days, F.to_date(ts) == F.col("_day"), "left")
    return tagged.withColumns({
        "is_holiday": F.col("_day").isNotNull().cast("int"),
        "holiday_name": F.coalesce("_holiday", F.lit("")),
    }).drop("_day", "_holiday")


def tag_traffic_holidays(df: DataFrame) -> DataFrame:
    """Traffic calendar: ``is_holiday``, ``is_pre_holiday`` and the name, which days before a holiday have too.

    Rush hours are lifted by holidays alone, so the two flags stay apart.
    """
    named = tag_holidays(df, dim_traffic_holiday(df.sparkSession))
    before = F.col("holiday_name") == PRE_HOLIDAY_NAME
    return named.withColumns({
        "is_holiday": F.col("is_holiday").cast("boolean") & ~before, "is_pre_holiday": before,
    })


def transform_categories(df: DataFrame, holidays: DataFrame | None = None, ts: str = "datetime") -> DataFrame:
    """Day type, season, weather and traffic categories, rush hour, holiday flag.

    ``ts`` names the clock they follow; an ``hour`` column that is there already is kept.
    """
    if ts == "datetime" and ts not in df.columns:
        df = ensure_datetime(df)
    clock = F.col(ts)
    df = df.withColumns({
        "day_of_week": calendar.day_of_week(clock),
        "month": F.month(clock),
        "hour": F.col("hour") if "hour" in df.columns else F.hour(clock),
    })
    weekend = calendar.is_weekend(F.col("day_of_week"))
    added = {
        "is_weekend": weekend,
        "day_type": calendar.day_type(weekend),
        "season": calendar.season(F.col("month")),
        "rush_hour": calendar.rush_hour(F.col("hour")),
    }
    if "temperature" in df.columns:
        added["weather_condition"] = binning.weather_condition(F.col("temperature"))
    if "traffic_index" in df.columns:
        added["traffic_level"] = binning.traffic_level_index(F.col("traffic_index"))
    # the national calendar only sets the flag; a feed's own holiday names stay
    own_name = "holiday_name" in df.columns
    tagged = df.withColumns(added)
    if own_name:
        tagged = tagged.withColumnRenamed("holiday_name", "_own_name")
    tagged = tag_holidays(tagged, holidays, ts).drop("holiday_name")
    return tagged.withColumnRenamed("_own_name", "holiday_name") if own_name else tagged


def gold_features(df: DataFrame) -> DataFrame:
    """Period of the day, season, rain flag and the three level columns of the unified table."""
    added = {
        "time_period": calendar.time_period(F.col("hour")),
        "season": calendar.season(F.col("month")),
    }
    optional = {
        "precipitation": ("is_rainy", weather.is_rainy),
        "temperature": ("temp_category", binning.temp_category),
        "aqi_avg": ("air_quality_level", binning.air_quality_level),
        "congestion_level": ("traffic_level", binning.traffic_level_congestion),
    }
    added |= {name: f(F.col(source)) for source, (name, f) in optional.items() if source in df.columns}
    return df.withColumns(added)


def time_features(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """Calendar parts and their cyclical encodings."""
    if ts not in df.columns:
        raise ValueError(f"{ts} column required")
    parts = df.withColumns(calendar.calendar_parts(F.col(ts)))
    return parts.withColumns(
        calendar.cyclical_encoding(F.col("hour"), F.col("day_of_week"), F.col("month"))
    )


def weather_features(df: DataFrame, wind_unit: str = "ms") -> DataFrame:
    """Heat index, wind chill and temperature range, where their inputs exist."""
    has = set(df.columns)
    added = {}
    if {"temperature", "humidity"} <= has:
        added["heat_index"] = weather.heat_index(F.col("temperature"), F.col("humidity"))
    if {"temperature", "wind_speed"} <= has:
        added["wind_chill"] = weather.wind_chill(F.col("temperature"), F.col("wind_speed"), wind_unit)
    if {"temp_max", "temp_min"} <= has:
        added["temp_range"] = weather.temp_range(F.col("temp_max"), F.col("temp_min"))
    return df.withColumns(added) if added else df


def _pollution_index(columns) -> Column:
    """Mean of pollutants over their 95th percentile; a zero percentile makes any positive value full."""
    shares = []
    for c in columns:
        top = F.col(quantile_name(c, INDEX_QUANTILE))
        unscaled = F.when((top == 0) & (F.col(c) > 0), 1.0).when((top == 0) & (F.col(c) < 0), 0.0)
        shares.append(F.coalesce(clip_range(F.try_divide(F.col(c), top), 0, 1), unscaled))
    return row_mean(shares)


def _interactions(df: DataFrame) -> dict:
    has = set(df.columns)
    pairs = {
        "wind_no2_interaction": ("wind_speed", "no2"),
        "wind_pm25_interaction": ("wind_speed", "pm25"),
        "humidity_temp_interaction": ("humidity", "temperature"),
    }
    return {name: F.col(a) * F.col(b) for name, (a, b) in pairs.items() if {a, b} <= has}


def _high_both(first: str, second: str) -> Column:
    high = [F.col(c) > F.col(quantile_name(c, HIGH_QUANTILE)) for c in (first, second)]
    return F.when(high[0] & high[1], 1).otherwise(0)


def interaction_terms(df: DataFrame) -> DataFrame:
    """Products of related measures, and the flag for hot hours with heavy traffic."""
    added = _interactions(df)
    result = df
    both = ("temperature", "traffic_index")
    if set(both) <= set(df.columns):
        result = attach_scalars(df, exact_quantiles(df, both, [HIGH_QUANTILE]))
        added = {"high_temp_high_traffic": _high_both(*both)} | added
    return result.withColumns(added).select(*df.columns, *added) if added else df


def high_temp_high_traffic(df: DataFrame) -> DataFrame:
    """1 where temperature and traffic index are both above their upper quartile."""
    both = ("temperature", "traffic_index")
    scaled = attach_scalars(df, exact_quantiles(df, both, [HIGH_QUANTILE]))
    return scaled.withColumn("high_temp_high_traffic", _high_both(*both)).select(*df.columns, "high_temp_high_traffic")


def pollution_index(df: DataFrame, cols=INDEX_POLLUTANTS) -> DataFrame:
    """Mean of the available pollutants, each scaled by its 95th percentile and clipped to [0, 1]."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return df
    scaled = attach_scalars(df, exact_quantiles(df, present, [INDEX_QUANTILE]))
    return scaled.withColumn("pollution_index", _pollution_index(present)).select(*df.columns, "pollution_index")


def pollution_features(df: DataFrame) -> DataFrame:
    """AQI sub-indices, combined index and PM ratio."""
    has = set(df.columns)
    added = {}
    if "pm25" in has:
        added["pm25_aqi"] = air.pm25_aqi(F.col("pm25"))
    if "pm10" in has:
        added["pm10_aqi"] = air.pm10_aqi(F.col("pm10"))
    if {"pm25", "pm10"} <= has:
        added["pm25_pm10_ratio"] = air.pm25_pm10_ratio(F.col("pm25"), F.col("pm10"))
    result = pollution_index(df)
    return result.withColumns(added) if added else result


def all_features(df: DataFrame, target_rows: int = TARGET_ROWS, ts: str = "datetime") -> DataFrame:
    """Time, weather, pollution and lag features of a merged table.

    Pressure tendency and lags share one pass over the ordered rows. The table is looked at several
    times (density, quantiles, borders of chunks, rows), so it is written once first.
    """
    df = written(df, "merged")
    density = measure_density(df, ("city_key",), "datetime")
    featured = pollution_features(weather_features(time_features(df, ts)))
    return pressure_and_lags(featured, LAG_COLUMNS, PIPELINE_LAGS, target_rows=target_rows, density=density)


def final_dataset(df: DataFrame, target_rows: int = TARGET_ROWS, ts: str = "datetime") -> DataFrame:
    """Rolling means, interaction terms and all features: the table reports are made from.

    ``ts`` names the clock of the calendar features; order always follows ``datetime``. The merged table and the
    rolling means are written once each.
    """
    df = written(df, "merged")
    density = measure_density(df, ("city_key",), "datetime")
    pollutants = [c for c in INDEX_POLLUTANTS if c in df.columns]
    rolled = df
    if pollutants:
        rolled = written(rolling_mean(
            df, [*pollutants, "temperature", "traffic_index"], target_rows=target_rows, density=density
        ), "rolled")
    featured = pollution_features(weather_features(time_features(interaction_terms(rolled), ts)))
    return pressure_and_lags(featured, LAG_COLUMNS, PIPELINE_LAGS, target_rows=target_rows, density=density)
