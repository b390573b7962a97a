"""Joins, cleaning, units, grids and city matching on small fixtures."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from aeroweave.dims import dim_city
from aeroweave.operators import cities, clean, features, grids, merge, schema, units


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_standardize_city(spark):
    names = ["Köln", " MÜNCHEN ", "Frankfurt am Main", "Düsseldorf", "Luebeck", "Atlantis", None]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, city string")
    want = ["cologne", "munich", "frankfurt", "dusseldorf", "lübeck", "atlantis", None]
    assert [r["city_key"] for r in cities.standardize_city(df).orderBy("i").collect()] == want
    assert [r["city_key"] for r in cities.standardize_city(df, dim_city(spark)).orderBy("i").collect()] == want


def test_match_and_first_station(spark):
    df = spark.createDataFrame(
        [(1, "Berlin Neukölln"), (2, "berlin"), (3, "München"), (4, "Nowhere"), (5, "Halle (Saale)"), (6, None)],
        "station_id int, city string")
    matched = cities.match_station_city(df)
    assert rows(matched, "station_id", "city_key") == [(1, "berlin"), (2, "berlin"), (3, "munich"), (5, "halle")]
    assert rows(cities.first_station(matched), "station_id", "city_key") == [(1, "berlin"), (3, "munich"), (5, "halle")]
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_nearest_station(spark):
    df = spark.createDataFrame([(1, 52.5, 13.4), (2, 52.5, 13.4), (3, 48.1, 11.6), (4, None, 1.0)],
                               "station_id int, lat double, lon double")
    near = {r["city_key"]: r["station_id"] for r in cities.nearest_station(df).collect()}
    assert near["berlin"] == 1 and near["munich"] == 3 and len(near) == 79


def test_nearest_station_sorts_no_pairs(spark):
    df = spark.createDataFrame([(2, 52.5, 13.4), (1, 52.5, 13.4), (3, float("nan"), 11.6)], "station_id int, lat double, lon double")
    found = cities.nearest_station(df)
    assert {r["station_id"] for r in found.collect()} == {1}
    assert cities.nearest_station(df.filter("lat is null")).collect() == []
    assert "Sort " not in df_plan(found)


def test_stations_are_matched_without_lambdas(spark):
    df = spark.createDataFrame([(2, "BERLIN"), (1, "Berlin-Mitte"), (3, "")], "station_id int, city string")
    matched = cities.match_station_city(df)
    assert matched.columns == ["station_id", "city", "city_key"]
    assert matched.filter("station_id = 3").count() == 79  # every name holds the empty one
    assert "lambda" not in df_plan(matched)
    first = cities.first_station(matched.filter("station_id < 3"))
    assert rows(first, "city_key", "station_id") == [("berlin", 1)]
    assert "lambda" not in df_plan(first)


def df_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def feed(table, name, cells):
    return table([(c, f"2024-01-01 0{h}:00:00", v) for c, h, v in cells], f"city_key string, datetime timestamp_ntz, {name} double")


def test_alignment_gives_equal_city_sets(table):
    w = feed(table, "t", [("a", 0, 1.0), ("b", 0, 1.0), ("c", 0, 1.0)])
    a = feed(table, "no2", [("a", 0, 1.0), ("b", 0, 1.0)])
    t = feed(table, "x", [("b", 0, 1.0), ("a", 1, 1.0), ("d", 1, 1.0)])
    for aligned in cities.align_cities(w, a, t):
        assert {r[0] for r in aligned.select("city_key").collect()} == {"a", "b"}
    assert rows(cities.dropped_cities(w, a, t), "feed", "city_key") == [("traffic", "d"), ("weather", "c")]


def test_merge_strategies(table):
    w = feed(table, "v", [("a", 0, 1.0), ("a", 1, 2.0)])
    a = feed(table, "v", [("a", 1, 3.0), ("a", 2, 4.0)])
    t = feed(table, "v", [("a", 1, 5.0), ("b", 3, 6.0)])
    hours = {how: [r[0].hour for r in merge.merge_feeds(w, a, t, how).select("datetime").orderBy("datetime").collect()]
             for how in ("inner", "outer", "left", "right")}
    assert hours == {"inner": [1], "outer": [0, 1, 2, 3], "left": [0, 1], "right": [1, 3]}
    both = merge.merge_feeds(w, a, t, "inner")
    assert both.columns == ["city_key", "datetime", "v", "datetime_aq", "v_aq", "datetime_traffic", "v_traffic"]
    with pytest.raises(ValueError):
        merge.merge_feeds(w, a, t, "cross")


def test_stations_are_averaged_before_the_merge(table):
    air = table([("a", "2024-01-01 00:10:00", "s1", 1.0), ("a", "2024-01-01 00:50:00", "s2", 4.0)],
                "city_key string, datetime timestamp_ntz, station_code string, no2 double")
    merged = merge.station_to_city_hour(merge.merge_prepare(air))
    assert rows(merged, "city_key", "no2") == [("a", 2.5)]


def test_pollutants_pivot_or_merge(table):
    long = table([("a", "2024-01-01 00:00:00", "NO2", 1.0), ("a", "2024-01-01 00:00:00", "NO2", 3.0),
                  ("a", "2024-01-01 00:00:00", "PM10", 5.0), ("a", "2024-01-01 01:00:00", "O3", None)],
                 "city_key string, datetime timestamp_ntz, pollutant string, value double")
    assert rows(merge.pivot_pollutants(long), "no2", "pm10", "o3") == [(2.0, 5.0, None)]
    no2 = feed(table, "no2", [("a", 0, 1.0)])
    o3 = feed(table, "o3", [("a", 1, 2.0)])
    assert rows(merge.merge_pollutants([no2, o3]), "no2", "o3") == [(1.0, None), (None, 2.0)]
    stacked = merge.merge_pollutants([no2.select("no2"), o3.select("o3")])
    assert rows(stacked, "no2", "o3") == [(1.0, None), (None, 2.0)]


def test_sparse_columns(spark):
    cells = [(i, None if i < 3 else float(i), None if i < 4 else float(i)) for i in range(10)]
    df = spark.createDataFrame(cells, "i int, kept double, lost double")
    got = schema.drop_sparse_columns(df, ["kept", "lost", "absent"])
    assert got.columns == ["i", "kept"]
    assert [r["kept"] for r in got.orderBy("i").collect()][:4] == [6.0, 6.0, 6.0, 3.0]


def test_unit_thresholds(spark):
    def one(column, values, feed):
        df = spark.createDataFrame([(float(v),) for v in values], f"{column} double")
        return sorted(r[0] for r in units.standardize_units(df, feed).collect())

    assert one("temperature", [32, 100], "weather") == [32.0, 100.0]
    assert one("temperature", [32, 104], "weather") == [0.0, 40.0]
    assert one("wind_speed", [0, 50], "weather") == [0.0, 50.0]
    assert one("wind_speed", [0, 72], "weather") == [0.0, 20.0]
    assert one("pressure", [1, 2], "weather") == [1000.0, 2000.0]
    assert one("pressure", [10, 100], "weather") == [100.0, 1000.0]
    assert one("pressure", [100, 1000], "weather") == [100.0, 1000.0]
    assert one("co", [1, 10], "air_quality") == [1.0, 10.0]
    assert one("co", [1, 9], "air_quality") == [1000.0, 9000.0]
    assert one("no2", [0.5], "air_quality") == [500.0]
    assert one("traffic_index", [0, 1], "traffic") == [0.0, 100.0]


def test_hourly_grid(table):
    df = table([("a", "2024-01-01 00:10:00", 1, None, "x"), ("a", "2024-01-01 00:20:00", 2, 5.0, "y"),
                ("a", "2024-01-01 03:00:00", 3, 7.0, None), ("b", "2024-01-01 02:00:00", 4, 9.0, "z")],
               "city_key string, datetime timestamp_ntz, _seq bigint, v double, s string")
    got = rows(grids.to_hourly(df), "city_key", "datetime", "v", "s", "date")
    day = date(2024, 1, 1)
    at = lambda h: datetime(2024, 1, 1, h)
    assert got == sorted([("a", at(0), 5.0, "x", day), ("a", at(1), 5.0, "x", day), ("a", at(2), None, None, day),
                          ("a", at(3), 7.0, None, day), ("b", at(2), 9.0, "z", day)], key=str)
    whole = rows(grids.to_hourly(df.drop("s"), keys=()), "datetime", "v")
    assert [v for _, v in whole] == [5.0, 5.0, 9.0, 7.0]


def test_daily_grid(table):
    df = table([("a", "2024-01-01 00:00:00", 1.0, 9.0, 4.0, "p"), ("a", "2024-01-01 05:00:00", 3.0, 2.0, 8.0, "q"),
                ("a", "2024-01-03 00:00:00", 5.0, 5.0, 5.0, None)],
               "city_key string, datetime timestamp_ntz, v double, temp_min double, temp_max double, s string")
    got = rows(grids.to_daily(df.withColumn("_seq", F.monotonically_increasing_id())), "date", "v", "temp_min", "temp_max")
    assert got == [(date(2024, 1, 1), 2.0, 2.0, 8.0), (date(2024, 1, 2), None, None, None), (date(2024, 1, 3), 5.0, 5.0, 5.0)]


def test_hour_spine_counts_the_last_midnight(spark):
    spans = spark.sql("select 'a' as city_key, '2024-01-01' as start, '2024-03-31' as end")
    assert grids.hour_spine(spans).count() == 2161
    assert grids.date_spine(spans).count() == 91


def bronze_traffic(table):
    return table(
        [("a", "2024-01-01 00:00:00", 1, None, 250.0, "New Year", 1), ("a", "2024-01-01 01:00:00", 2, 0.5, None, None, 0),
         ("a", "2024-01-01 01:00:00", 3, 0.9, -4.0, None, 0), ("b", "2024-01-01 00:00:00", 4, None, 20.0, None, None)],
        "city_key string, datetime timestamp_ntz, _seq bigint, congestion_level double, current_speed double, "
        "holiday_name string, is_holiday int",
    )


def test_clean_traffic(table):
    got = rows(clean.clean_traffic(bronze_traffic(table)),
               "city_key", "hour", "congestion_level", "current_speed", "holiday_name", "is_holiday")
    # values never cross cities, holiday names are never carried, a missing flag counts as true
    assert got == [("a", 0, 0.5, 200.0, "New Year", True), ("a", 1, 0.5, 200.0, "", False), ("b", 0, 0.0, 20.0, "", True)]


def test_clean_metrics(table):
    m = clean.clean_metrics(bronze_traffic(table), "traffic").first()
    assert (m["rows_before"], m["rows_after"], m["duplicates_removed"]) == (4, 3, 1)
    assert m["nulls_filled"] == 2 + 1 + 3 and m["nulls_dropped"] == 0
    # speeds above 200 are clipped but only those below zero count as outliers
    assert (m["outliers_clipped"], m["values_clipped"]) == (0, 2)


def test_clean_air_keeps_text_and_zeroes_unknown_pollutants(table):
    df = table([("a", "2024-01-01 00:00:00", 1, "st", None, 600.0, None), ("a", "2024-01-01 01:00:00", 2, "st", None, None, None)],
               "city_key string, datetime timestamp_ntz, _seq bigint, station_name string, no2 double, pm10 double, note string")
    got = clean.clean_air_quality(df)
    assert "station_name" not in got.columns
    assert rows(got, "no2", "pm10", "aqi_avg", "note") == [(0.0, 500.0, 250.0, None)] * 2


def test_silver_is_within_bounds_and_unique(table):
    cells = [("a", f"2024-01-01 {h % 24:02d}:00:00", h, -90.0 + 7 * (h % 24), float(h % 24 * 9), float(h % 24), -1.0) for h in range(48)]
    df = table(cells, "city_key string, datetime timestamp_ntz, _seq bigint, temperature double, humidity double, wind_speed double, precipitation double")
    got = clean.clean_weather(df)
    low, high, wet, n, keys = got.agg(F.min("temperature"), F.max("humidity"), F.min("precipitation"), F.count("*"),
                                      F.count_distinct("city_key", "datetime")).first()
    assert (low, high, wet, n, keys) == (-40.0, 100.0, 0.0, 24, 24)


def test_pollution_index(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, None), (3, 0.0, 20.0)], "i int, no2 double, pm10 double")
    got = [r["pollution_index"] for r in features.pollution_index(df).orderBy("i").collect()]
    # no2 has a zero percentile and is unknown where it is zero, so pm10 alone decides
    assert abs(got[0] - 10 / 19.5) < 1e-12 and got[1] is None and got[2] == 1.0
    spiky = spark.createDataFrame([(0.0,)] * 99 + [(4.0,)], "no2 double")
    assert {r[0] for r in features.pollution_index(spiky).select("pollution_index").collect()} == {None, 1.0}


def test_high_temp_high_traffic(spark):
    df = spark.createDataFrame([(float(i), float(i) if i else None) for i in range(5)], "temperature double, traffic_index double")
    got = features.high_temp_high_traffic(df).orderBy("temperature").collect()
    assert [r["high_temp_high_traffic"] for r in got] == [0, 0, 0, 0, 1]


def test_traffic_holidays(table):
    df = table([("2024-01-01 10:00:00",), ("2024-03-30 10:00:00",), ("2024-02-01 10:00:00",)], "datetime timestamp_ntz")
    assert rows(features.tag_traffic_holidays(df), "is_holiday", "is_pre_holiday", "holiday_name") == [
        (False, False, ""), (False, True, "Pre-Holiday Travel"), (True, False, "New Year")]
