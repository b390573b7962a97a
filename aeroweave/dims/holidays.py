"""Holiday calendars: national days by rule, and the dated list used for traffic."""

from __future__ import annotations

from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# National holidays of Germany. Whole numbers are days from Easter Sunday,
# pairs are (month, day).
NATIONAL_DAYS = {
    "Neujahr": (1, 1),
    "Karfreitag": -2,
    "Ostermontag": 1,
    "Erster Mai": (5, 1),
    "Christi Himmelfahrt": 39,
    "Pfingstmontag": 50,
    "Tag der Deutschen Einheit": (10, 3),
    "Erster Weihnachtstag": (12, 25),
    "Zweiter Weihnachtstag": (12, 26),
}

# Dates that change traffic in the first quarter of 2024, with their load
TRAFFIC_DAYS = {
    "2024-01-01": ("New Year", "high"),
    "2024-01-06": ("Epiphany", "moderate"),
    "2024-03-29": ("Good Friday", "high"),
    "2024-03-31": ("Easter Sunday", "high"),
}
PRE_HOLIDAY_DATES = ["2023-12-31", "2024-03-28", "2024-03-30"]
PRE_HOLIDAY_NAME = "Pre-Holiday Travel"


def easter_sunday(year: int) -> date:
    """Gregorian Easter (Meeus/Jones/Butcher)."""
    golden = year % 19
    century, in_century = divmod(year, 100)
    leap_skips, century_rest = divmod(century, 4)
    moon_shift = (century - (century + 8) // 25 + 1) // 3
    epact = (19 * golden + century - leap_skips - moon_shift + 15) % 30
    leaps, year_rest = divmod(in_century, 4)
    weekday = (32 + 2 * century_rest + 2 * leaps - epact - year_rest) % 7
    late = (golden + 11 * epact + 22 * weekday) // 451
    month, day = divmod(epact + weekday - 7 * late + 114, 31)
    return date(year, month, day + 1)


def national_holidays(years=(2023, 2024)) -> list[tuple[date, str]]:
    days = []
    for year in years:
        easter = easter_sunday(year)
        for name, rule in NATIONAL_DAYS.items():
            day = easter + timedelta(days=rule) if isinstance(rule, int) else date(year, *rule)
            days.append((day, name))
    return sorted(days)


def dim_holiday(spark: SparkSession, years=(2023, 2024)) -> DataFrame:
    """date, name of the national holidays (nine a year)."""
    days = national_holidays(years)
    return spark.createDataFrame(pa.table({
        "date": pa.array([d for d, _ in days], pa.date32()),
        "name": [n for _, n in days],
    }))


def dim_traffic_holiday(spark: SparkSession) -> DataFrame:
    """date, name, level of the traffic calendar; days before a holiday carry no level."""
    rows = [(date.fromisoformat(d), n, level) for d, (n, level) in TRAFFIC_DAYS.items()]
    rows += [(date.fromisoformat(d), PRE_HOLIDAY_NAME, None) for d in PRE_HOLIDAY_DATES]
    return spark.createDataFrame(pa.table({
        "date": pa.array([r[0] for r in rows], pa.date32()),
        "name": [r[1] for r in rows],
        "level": pa.array([r[2] for r in rows], pa.string()),
    }))
