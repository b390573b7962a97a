from datetime import date, datetime
from math import isclose, nan

import pytest
from pyspark.sql import functions as F

from aeroweave.dims import CITIES, national_holidays
from aeroweave.functions import air, binning, calendar, numeric, traffic, weather
from aeroweave.functions.student import pearson_p_value


def column(spark, values, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clip_keeps_nulls(spark):
    got = column(spark, [-1.0, 0.0, 7.0, 500.0, 501.0, None], lambda v: numeric.clip_range(v, 0, 500))
    assert got == [0.0, 0.0, 7.0, 500.0, 500.0, None]
    assert column(spark, [nan, 1.0], numeric.nan_to_null) == [None, 1.0]


def test_row_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 2.0, 4.0), (3, None, None)], "i int, a double, b double")
    assert [r[0] for r in df.orderBy("i").select(numeric.row_mean([F.col("a"), F.col("b")])).collect()] == [1.0, 3.0, None]


def test_cut_edges(spark):
    assert column(spark, [0.0, 0.1, 30.0, 30.1, 70.0, 100.0, 100.1, None], binning.traffic_level_index) == [
        None, "low", "low", "medium", "medium", "high", None, None]
    assert column(spark, [0.0, 20.0], lambda v: binning.traffic_level_index(v, include_lowest=True)) == ["low", "low"]
    assert column(spark, [-1e9, 5.0, 5.1, 20.0, 21.0, None], binning.weather_condition) == [
        "cold", "cold", "mild", "mild", "warm", None]
    assert column(spark, [0.0, 0.3, 0.6, 1.0, 1.1], binning.traffic_level_congestion) == [
        None, "free_flow", "moderate", "congested", None]
    assert column(spark, [-50.0, -49.0, 0.0, 10.0, 50.0, 51.0], binning.temp_category) == [
        None, "freezing", "freezing", "cold", "warm", None]
    assert column(spark, [0.0, 20.0, 20.5, 80.1, 100.0], binning.traffic_band) == [
        "free_flow", "free_flow", "light", "severe", "severe"]
    with pytest.raises(ValueError):
        binning.cut(F.lit(1), (0, 1), ("a", "b"))


def test_cut_treats_float32_as_the_wider_value(spark):
    # 0.3 as a float is a little more than 0.3, so it falls into the next bin
    assert column(spark, [0.3], lambda v: binning.traffic_level_congestion(v.cast("float"))) == ["moderate"]


def test_local_time_at_the_clock_changes(spark):
    times = ["2024-03-31 00:30:00", "2024-03-31 01:30:00", "2024-10-27 00:30:00", "2024-10-27 01:30:00"]
    got = column(spark, times, lambda v: calendar.to_local_time(v.cast("timestamp_ntz")), "string")
    assert got == [datetime(2024, 3, 31, 1, 30), datetime(2024, 3, 31, 3, 30),
                   datetime(2024, 10, 27, 2, 30), datetime(2024, 10, 27, 2, 30)]


def test_calendar(spark):
    df = spark.sql("select timestamp_ntz'2024-12-30 07:15:00' as ts")
    parts = df.select(*[c.alias(n) for n, c in calendar.calendar_parts(F.col("ts")).items()]).first()
    assert tuple(parts) == (2024, 12, 30, 7, 0, 365, 1)
    hours = list(range(24))
    periods = column(spark, hours, calendar.time_period, "int")
    assert [h for h in hours if periods[h] == "night"] == [0, 1, 2, 3, 4, 5, 23]
    assert [periods[h] for h in (6, 9, 10, 15, 16, 19, 20, 22)] == [
        "morning_rush"] * 2 + ["midday"] * 2 + ["evening_rush"] * 2 + ["evening"] * 2
    assert [h for h in hours if column(spark, [h], calendar.rush_hour, "int") == ["morning"]] == [7, 8, 9]
    nights = column(spark, hours, calendar.is_night, "int")
    assert [h for h in hours if nights[h]] == [0, 1, 2, 3, 4, 5, 22, 23]
    assert column(spark, [1, 4, 7, 10, 12], calendar.season, "int") == ["winter", "spring", "summer", "autumn", "winter"]


def test_holidays():
    days = dict(national_holidays())
    assert len(days) == 18
    assert days[date(2024, 3, 29)] == "Karfreitag" and days[date(2023, 5, 18)] == "Christi Himmelfahrt"
    assert days[date(2024, 5, 20)] == "Pfingstmontag" and date(2024, 12, 26) in days


def test_aqi_at_break_points(spark):
    got = column(spark, [0.0, 12.0, 35.4, 55.4, 150.4, 250.4, 500.0, 749.6, None], air.pm25_aqi)
    assert all(isclose(g, w, abs_tol=1e-9) for g, w in zip(got, [0, 50, 100, 150, 200, 300, 400, 500]))
    assert got[-1] is None
    got = column(spark, [0.0, 54.0, 154.0, 254.0, 354.0, 424.0, 604.0, 784.0], air.pm10_aqi)
    assert all(isclose(g, w, abs_tol=1e-9) for g, w in zip(got, [0, 50, 100, 150, 200, 300, 400, 500]))


def test_wind_chill(spark):
    df = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 5.0, 1.33), (4, 5.0, None), (5, None, 5.0)],
                               "i int, t double, v double")
    plain = [r[0] for r in df.orderBy("i").select(weather.wind_chill(F.col("t"), F.col("v"))).collect()]
    p = 5.0 ** 0.16
    assert isclose(plain[0], 13.12 + 0.6215 * 5 - 11.37 * p + 0.3965 * 5 * p)
    assert plain[1:] == [10.0, 5.0, 5.0, None]
    with pytest.raises(ValueError):
        weather.wind_chill(F.col("t"), F.col("v"), "knots")


def test_congestion(spark):
    df = spark.createDataFrame([(1, 14.0, 43.0), (2, 0.0, 43.0), (3, 10.0, 0.0), (4, None, 1.0)], "i int, a double, b double")
    got = [r[0] for r in df.orderBy("i").select(traffic.congestion_level(F.col("a"), F.col("b"))).collect()]
    assert isclose(got[0], 0.6744186, abs_tol=1e-6) and got[1:] == [None, None, None]


def test_p_values_against_known_ones():
    # t = 2.228 with 10 degrees of freedom is the two-sided 5 % point; likewise 12.706 with 1
    for t, v, p in ((2.228139, 10, 0.05), (12.7062, 1, 0.05), (1.979930, 120, 0.05), (1.0, 1, 0.5)):
        r = t / (v + t * t) ** 0.5
        assert isclose(pearson_p_value(r, v + 2), p, rel_tol=1e-4)
    # both forms agree where one takes over from the other
    assert isclose(pearson_p_value(1e-3, 9_999_999), pearson_p_value(1e-3, 10_000_001), rel_tol=1e-4)
    assert pearson_p_value(1.0, 10) == 0.0 and pearson_p_value(0.0, 10) == 1.0


def test_cities():
    assert len(CITIES) == 79 and len({c.city_key for c in CITIES}) == 79
