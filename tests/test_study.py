"""Statistics, quality tables, files and the registry."""

import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

import __spark_entry__ as registry
from aeroweave.operators import quality, stats
from aeroweave.plans import medallion
from aeroweave.sources import feeds, payloads, readers, writers


@pytest.fixture(scope="module")
def sample(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        t, x, w, p = rng.gauss(10, 5), rng.uniform(0, 100), rng.uniform(0, 9), rng.uniform(0, 3)
        rows.append((f"c{i % 3}", None if i % 17 == 0 else 2 * x - t + rng.gauss(0, 9), t, None if i % 13 == 0 else x, w, p, 7.0))
    schema = "city string, no2 double, temperature double, traffic_index double, wind_speed double, precipitation double, pressure double"
    return spark.createDataFrame(rows, schema).cache(), pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])


def test_correlations_match_pandas(sample):
    df, frame = sample
    want = frame.drop(columns="city").corr()
    for r in stats.correlation_matrix(df).collect():
        w = want.loc[r["x"], r["y"]]
        assert (r["r"] is None and np.isnan(w)) or abs(r["r"] - w) < 1e-9
        assert r["r"] is None or -1 <= r["r"] <= 1


def test_p_values_match_the_regression_slope(sample):
    df, _ = sample
    tests = {r["predictor"]: r for r in stats.pearson_tests(df).collect()}
    assert set(tests) == {"traffic_index", "temperature", "wind_speed"}
    for x, row in tests.items():
        known = VectorAssembler(inputCols=[x], outputCol="features").transform(df.dropna(subset=[x, "no2"]))
        fit = LinearRegression(labelCol="no2", solver="normal").fit(known)
        assert abs(fit.summary.pValues[0] - row["p_value"]) < 1e-9
    assert tests["traffic_index"]["significance"] == "***"


def test_one_row_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "no2 double, temperature double")
    assert stats.pair_correlations(df, [("temperature", "no2")]).first()["r"] is None
    assert stats.pearson_tests(df).count() == 0


def test_regression_matches_ml(sample):
    df, _ = sample
    xs = list(stats.REGRESSION_PREDICTORS)
    got = {r["term"]: r for r in stats.pollutant_regression(df).collect()}
    known = VectorAssembler(inputCols=xs, outputCol="features").transform(df.dropna(subset=[*xs, "no2"]))
    fit = LinearRegression(labelCol="no2", solver="normal").fit(known)
    for x, w in zip(xs, fit.coefficients):
        assert abs(got[x]["coefficient"] - w) < 1e-8
    assert abs(got["intercept"]["coefficient"] - fit.intercept) < 1e-7
    assert abs(got["intercept"]["r2"] - fit.summary.r2) < 1e-9 and got["intercept"]["n"] == known.count()
    assert {r["city"] for r in stats.pollutant_regression(df, by=["city"]).select("city").distinct().collect()} == {"c0", "c1", "c2"}


def test_regression_needs_more_rows_than_predictors(sample):
    df, _ = sample
    known = df.dropna()
    assert stats.pollutant_regression(known.limit(4)).count() == 0
    assert stats.pollutant_regression(known.limit(5)).count() == 5


def test_iqr_fence_itself_is_kept(spark):
    # quartiles 2 and 4, fences -1 and 7
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 7.0)], "v double")
    assert quality.iqr_outliers(df, ["v"]).first()["outliers"] == 0
    assert quality.remove_iqr_outliers(df.union(df.selectExpr("v + 100")), ["v"]).count() == 10
    far = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, 7.1, None)], "v double")
    assert quality.iqr_outliers(far.filter("v is null or v <> 7.1").union(spark.createDataFrame([(99.0,)], "v double")), ["v"]).first()["outliers"] == 1


def test_payloads(spark):
    text = '{"data":{"158":{"2024-01-01 01:00:00":["2024-01-01 01:59:59",1,0,[1, 20,0,"1"],[3,"21",0],[5,null,1],[5,27,1]],' \
           '"2024-01-01 02:00:00":["2024-01-01 02:59:59",1,0],"bad":["x",1,0,[4],[2,"n/a"]]}}}'
    got = payloads.flatten_measurements(spark.createDataFrame([(text,)], "payload string"))
    cells = sorted((r["component"], r["value"], r["datetime"] is None) for r in got.collect() if r["value"] is not None)
    assert cells == [("O3", 21.0, False), ("PM10", 20.0, False)]
    assert [(r["component"], r["value"], r["datetime"]) for r in got.filter("value is null").collect()] == [("PM2.5", None, None)]
    stations = '{"data":{"7":["7","DE7","North","Berlin","BE","a","b","13.4","52.5",1],"8":["8","short"]}}'
    flat = payloads.flatten_stations(spark.createDataFrame([(stations,)], "payload string")).collect()
    assert [(r["station_id"], r["station_code"], r["latitude"]) for r in flat] == [("7", "DE7", "52.5")]
    flow = spark.createDataFrame([('{"flowSegmentData":{"currentSpeed":0,"freeFlowSpeed":43,"confidence":1}}',), ("{}",)], "payload string")
    assert [r["traffic_index"] for r in payloads.normalize_traffic_flow(flow).collect()] == [None, None]


def test_files(spark, tmp_path):
    df = spark.sql("select 'a' as city_key, timestamp_ntz'2024-01-01 00:00:00.123456' as datetime, date'2024-01-01' as date, 1.5 as v "
                   "union all select 'b', timestamp_ntz'2024-01-02 00:00:00', date'2024-01-02', 2.5")
    written = writers.save_dual(df, str(tmp_path / "out"))
    assert dict(written.dtypes)["date"] == "string"
    back = readers.load(spark, str(tmp_path / "out.csv"), "city_key string, datetime timestamp_ntz, date string, v double")
    assert sorted(map(str, back.collect())) == sorted(map(str, written.withColumn("v", F.col("v").cast("double")).collect()))
    writers.save_by_city(df, str(tmp_path / "cities"))
    assert sorted(p.name for p in (tmp_path / "cities").glob("city_key=*")) == ["city_key=a", "city_key=b"]
    with pytest.raises(ValueError):
        writers.save(df, str(tmp_path / "x"), "xlsx")
    with pytest.raises(ValueError):
        readers.load(spark, "table.xlsx")
    with pytest.raises(FileNotFoundError):
        readers.latest(spark, str(tmp_path), "nothing_*")
    loaded = readers.load_feeds(spark, {"weather": str(tmp_path / "out.parquet"), "traffic": str(tmp_path / "no.csv"), "x": None})
    assert list(loaded) == ["weather"]


def test_station_csv_prefers_value(spark):
    df = spark.createDataFrame([("2024-01-01 05:00:00", None, 2.0), ("soon", 1.0, 2.0)], "DatetimeBegin string, Value double, Concentration double")
    got = feeds.import_station_csv(df, "cologne").collect()
    assert [(r["value"], r["hour"], r["city"]) for r in got] == [(2.0, 5, "Cologne"), (1.0, None, "Cologne")]
    with pytest.raises(KeyError):
        feeds.import_station_csv(df, "atlantis")


def test_end_to_end(spark, tmp_path):
    from catalog.bindings import Tables

    bronze = dict(zip(medallion.FEEDS, Tables(spark, "/root/testdata/sf0.001").bronze))
    silver = medallion.build_silver(spark, bronze, str(tmp_path / "silver"))
    cities = [{r[0] for r in df.select("city_key").distinct().collect()} for df in silver.values()]
    assert cities[0] == cities[1] == cities[2] and not [c for c in cities[0] if c.startswith(("signup", "annex"))]
    gold = medallion.build_gold(silver, str(tmp_path / "gold"))
    sizes = [df.count() for df in silver.values()]
    assert 0 < gold.count() <= min(sizes)
    final = medallion.build_final(silver, "inner")
    assert {"no2_rolling_30d", "pressure_change_rate", "no2_lag_24h", "pollution_index", "hour_sin"} <= set(final.columns)
    assert final.count() > 0


# searches and trees that SQL does not express; test_inference.py holds them against straight versions
WITHOUT_SQL = {"arima_fit", "arima_forecast", "boosted_trees", "isolation_scores", "density_clusters"}


def test_registry_is_complete():
    own = {n for n in registry.queries() if not re.match(r"op\d+_|pipeline$", n)}
    assert own - WITHOUT_SQL == {n for n in registry.oracle_sql() if not re.match(r"op\d+_|pipeline$", n)}


LIGHT = ["gold_air_quality_levels", "dedupe_keep_first", "fill_forward_back", "rolling_7d", "lag_features", "correlation_matrix",
         "pearson_tests", "summary_statistics_by_city", "flatten_measurements", "spearman_with_gaps", "kpss_test", "group_tests", "merge_outer", "to_local_time", "temporal_gaps"]


@pytest.mark.parametrize("name", LIGHT)
def test_query_matches_its_sql(spark, name):
    from tools_check import TABLES, canonical

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    df = registry.queries()[name](spark, folder)
    result = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())


@pytest.mark.parametrize("name", ["gold_features", "all_features", "temporal_gaps", "resample_hourly_first"])
def test_plans_stay_distributed(spark, name):
    """No window over the whole table, no row-wise Python, no unhinted product of tables."""
    plan = registry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
    for line in plan.splitlines():
        if re.search(r"^\W*Window \[", line):
            assert "specifiedwindowframe" in line and not re.search(r"windowspecdefinition\((specifiedwindowframe|[^,]* ASC)", line)
