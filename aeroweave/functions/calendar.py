"""Calendar and clock expressions over naive UTC timestamps."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Berlin"

# The two label sets in use, in the order winter, spring, summer, autumn
SEASON_LABELS = ("winter", "spring", "summer", "autumn")
STUDY_SEASON_LABELS = ("Winter", "Spring", "Summer", "Fall")

# First hour of each period of the day; night fills the rest
TIME_PERIODS = (("morning_rush", 6, 10), ("midday", 10, 16), ("evening_rush", 16, 20), ("evening", 20, 23))


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a naive UTC timestamp (session zone must be UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast("timestamp_ntz")


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def day_floor(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def to_local_time(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Naive UTC to naive local wall-clock time, daylight saving included.

    The local hour repeats in October, so tables are merged on UTC, never on this.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def day_of_week(ts: Column) -> Column:
    """0 = Monday."""
    return F.weekday(ts)


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": day_of_week(ts),
        "day_of_year": F.dayofyear(ts),
        "week_of_year": F.weekofyear(ts),
    }


def cyclical_encoding(hour: Column, weekday: Column, month: Column) -> dict[str, Column]:
    encoded = {}
    for name, value, period in (("hour", hour, 24), ("day_of_week", weekday, 7), ("month", month, 12)):
        angle = F.lit(2 * pi) * value / F.lit(period)
        encoded[f"{name}_sin"] = F.sin(angle)
        encoded[f"{name}_cos"] = F.cos(angle)
    return encoded


def is_night(hour: Column) -> Column:
    return (hour < 6) | (hour >= 22)


def is_weekday(weekday: Column) -> Column:
    return weekday < 5


def is_weekend(weekday: Column) -> Column:
    """0/1 flag."""
    return weekday.isin(5, 6).cast("int")


def day_type(weekend_flag: Column) -> Column:
    return F.when(weekend_flag == 0, "weekday").when(weekend_flag == 1, "weekend")


def season(month: Column, labels=SEASON_LABELS) -> Column:
    """Meteorological seasons; December belongs to the winter of January."""
    winter, spring, summer, autumn = labels
    return (
        F.when(month.isin(12, 1, 2), winter)
        .when(month.between(3, 5), spring)
        .when(month.between(6, 8), summer)
        .when(month.between(9, 11), autumn)
    )


def rush_hour(hour: Column) -> Column:
    return F.when(hour.between(7, 9), "morning").when(hour.between(17, 19), "evening").otherwise("none")


def is_rush_hour(hour: Column, weekday: Column, holiday: Column) -> Column:
    """Commuting hours of a working day."""
    return (hour.between(7, 9) | hour.between(17, 19)) & is_weekday(weekday) & ~holiday.cast("boolean")


def time_period(hour: Column) -> Column:
    period = F.lit("night")
    for name, start, end in TIME_PERIODS:
        period = F.when((hour >= start) & (hour < end), name).otherwise(period)
    return period


def snapshot_name(prefix: str, ts: Column) -> Column:
    """File name stem carrying the time it was taken, such as ``weather_data_20240131_070500``."""
    return F.concat(F.lit(prefix + "_"), F.date_format(ts, "yyyyMMdd_HHmmss"))
