"""Operators that follow time: the chunked plans must give what a plain window gives."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aeroweave.functions.calendar import micros
from aeroweave.operators import fills, lags, quality, rolling
from aeroweave.plans.chunks import in_chunks
from aeroweave.plans.quantiles import exact_quantiles

T0 = datetime(2024, 1, 1)


def history(spark, cities, hours, copies=1, gaps=0.3, seed=1, hot=0):
    """Rows (city_key, datetime, _seq, a, b); ``hot`` adds copies of one instant of one city."""
    rng = random.Random(seed)
    rows, seq = [], 0
    for city in range(cities):
        for h in range(hours):
            if rng.random() < 0.15:
                continue
            for _ in range(1 + rng.randrange(copies)):
                a = None if rng.random() < gaps or city == cities - 1 else round(rng.uniform(0, 100), 2)
                b = None if rng.random() < 0.8 else float(h)
                rows.append((f"c{city}", T0 + timedelta(hours=h), seq, a, b))
                seq += 1
    for i in range(hot):
        rows.append(("c0", T0 + timedelta(hours=5), seq, None if i < hot - 3 else float(i), None))
        seq += 1
    rng.shuffle(rows)
    frame = pd.DataFrame(rows, columns=["city_key", "datetime", "_seq", "a", "b"])
    df = spark.createDataFrame(rows, "city_key string, datetime timestamp_ntz, _seq bigint, a double, b double")
    return df, frame.sort_values(["city_key", "datetime", "_seq"], ignore_index=True)


def as_rows(df, columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def pandas_rows(frame, columns):
    clean = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(
        tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row)
        for row in clean.itertuples(index=False)
    )


@pytest.mark.parametrize("target", [500_000, 40, 2], ids=["single", "chunks", "ranges"])
def test_fill_matches_pandas(spark, target):
    df, frame = history(spark, 3, 120, copies=3)
    got = fills.fill_ffill_bfill(df, ["a", "b"], target_rows=target)
    for c in ("a", "b"):
        frame[c] = frame.groupby("city_key")[c].transform(lambda s: s.ffill().bfill())
    columns = ["city_key", "_seq", "a", "b"]
    key = lambda rows: sorted(rows, key=lambda r: r[1])
    assert key(tuple(r) for r in got.select(*columns).collect()) == key(
        tuple(None if v != v else v for v in row) for row in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("target", [500_000, 40, 1], ids=["single", "chunks", "ranges"])
def test_fill_and_keep_first_is_fill_then_dedupe(spark, target):
    df, frame = history(spark, 3, 120, copies=4, hot=400)
    got = fills.fill_and_keep_first(df, ["a", "b"], target_rows=target)
    for c in ("a", "b"):
        frame[c] = frame.groupby("city_key")[c].transform(lambda s: s.ffill().bfill())
    first = frame.drop_duplicates(["city_key", "datetime"])
    columns = ["city_key", "_seq", "a", "b"]
    key = lambda rows: sorted(rows, key=lambda r: r[1])
    assert key(tuple(r) for r in got.select(*columns).collect()) == key(
        tuple(None if v != v else v for v in row) for row in first[columns].itertuples(index=False))


def test_copies_are_reduced_before_the_shuffle(spark):
    df, _ = history(spark, 2, 50, copies=2, hot=100)
    plan = fills.fill_and_keep_first(df, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan
    ranked = fills.dedupe_keep_first(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in ranked and "Partial" in ranked


def test_dedupe_keeps_the_first_and_is_idempotent(spark):
    df, frame = history(spark, 2, 60, copies=4)
    once = fills.dedupe_keep_first(df)
    assert as_rows(once, ["_seq"]) == pandas_rows(frame.drop_duplicates(["city_key", "datetime"]), ["_seq"])
    assert as_rows(fills.dedupe_keep_first(once), ["_seq"]) == as_rows(once, ["_seq"])


def test_dedupe_without_source_order_is_refused(spark):
    df, _ = history(spark, 2, 60, copies=4)
    with pytest.raises(ValueError, match="_seq"):
        fills.dedupe_keep_first(df.drop("_seq"))


def unknown_history(spark):
    """Cities and times that are not known among the others, with values on both sides."""
    times = [None, None, None, *(T0 + timedelta(hours=h) for h in (0, 1, 2, 30, 31, 900, 901))]
    rows = [(c, t, i + 20 * k, None if (i + k) % 3 == 0 else float(i + 10 * k)) for k, c in enumerate(("x", None, "y")) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "city_key string, datetime timestamp_ntz, _seq bigint, a double")


@pytest.mark.parametrize("operator", ["fill", "keep", "limit", "lags", "rolling"])
def test_unknown_keys_and_times_give_one_answer_at_every_target(spark, operator):
    df = unknown_history(spark)
    run = {
        "fill": lambda n: fills.fill_ffill_bfill(df, ["a"], target_rows=n),
        "keep": lambda n: fills.fill_and_keep_first(df, ["a"], target_rows=n),
        "limit": lambda n: fills.fill_forward_limit1(df, ["a"], target_rows=n),
        "lags": lambda n: lags.lag_features(df, ["a"], lags=(1, 2), target_rows=n),
        "rolling": lambda n: rolling.rolling_mean(df, ["a"], days=(1, 7), target_rows=n),
    }[operator]
    answers = [sorted(map(str, run(n).collect())) for n in (500_000, 7, 1)]
    assert answers[0] == answers[1] == answers[2]
    if operator == "rolling":
        rows = {(r.city_key, r.datetime): r for r in run(500_000).collect() if r.datetime}
        assert rows[None, T0 + timedelta(hours=31)]["a_rolling_7d"] == 15.0


def test_rolling_mean_forgets_a_very_large_value(spark):
    rows = [("c", T0 + timedelta(hours=h), h, 1e17 if h == 3 else 1.0) for h in range(80)]
    df = spark.createDataFrame(rows, "city_key string, datetime timestamp_ntz, _seq bigint, a double")
    for target in (500_000, 1):
        got = {r["_seq"]: r["a_rolling_1d"] for r in rolling.rolling_mean(df, ["a"], days=(1,), target_rows=target).collect()}
        assert all(got[h] == 1.0 for h in [0, 1, 2, *range(27, 80)]) and got[20] > 1e14


def test_a_quantile_bracket_that_misses_is_widened(spark):
    df = spark.range(20_000).selectExpr("cast(id as double) as v", "id % 3 as k")
    for by in ((), ("k",)):
        narrow = [tuple(r) for r in exact_quantiles(df, ["v"], [0.1, 0.5, 0.99], by, margin=1e-7).orderBy(*(by or ["v_q50"])).collect()]
        usual = [tuple(r) for r in exact_quantiles(df, ["v"], [0.1, 0.5, 0.99], by).orderBy(*(by or ["v_q50"])).collect()]
        assert narrow == usual


@pytest.mark.parametrize("target", [500_000, 30, 0], ids=["single", "chunks", "ranges"])
def test_lags_match_pandas(spark, target):
    df, frame = history(spark, 3, 150)
    got = lags.lag_features(df, ["a"], lags=(1, 6, 24), target_rows=target).na.fill(-1.0)
    for n in (1, 6, 24):
        frame[f"a_lag_{n}h"] = frame.groupby("city_key")["a"].shift(n)
    columns = ["_seq", "a_lag_1h", "a_lag_6h", "a_lag_24h"]
    assert as_rows(got, columns) == pandas_rows(frame.fillna(-1.0), columns)


def test_lags_with_a_pile_of_copies(spark):
    df, frame = history(spark, 2, 40, copies=2, hot=300)
    got = lags.lag_features(df, ["a"], lags=(1, 6), target_rows=50).na.fill(-1.0)
    for n in (1, 6):
        frame[f"a_lag_{n}h"] = frame.groupby("city_key")["a"].shift(n)
    columns = ["_seq", "a_lag_1h", "a_lag_6h"]
    assert as_rows(got, columns) == pandas_rows(frame.fillna(-1.0), columns)


def test_lag_reaches_over_sparse_chunks(spark):
    rows = [("x", T0 + timedelta(days=400 * i), i, float(i), None) for i in range(8)]
    rows += [("y", T0 + timedelta(hours=i), 100 + i, float(i), None) for i in range(60)]
    df = spark.createDataFrame(rows, "city_key string, datetime timestamp_ntz, _seq bigint, a double, b double")
    got = {r["_seq"]: r["a_lag_3h"] for r in lags.lag_features(df, ["a"], lags=(3,), target_rows=10).collect()}
    assert [got[i] for i in range(8)] == [None, None, None, 0.0, 1.0, 2.0, 3.0, 4.0]
    assert got[159] == 56.0


def test_pressure_rate_over_no_time_is_null(spark, table):
    df = table([("x", "2024-01-01 00:00:00", 1000.0), ("x", "2024-01-01 00:00:00", 1004.0),
                ("x", "2024-01-01 02:00:00", 1010.0), ("z", "2024-01-01 02:00:00", 1.0)],
               "city_key string, datetime timestamp_ntz, pressure double")
    rates = [r["pressure_change_rate"] for r in lags.pressure_change(df).collect()]
    assert rates.count(None) == 3 and [r for r in rates if r is not None][0] in (3.0, 5.0)


@pytest.mark.parametrize("target", [500_000, 5], ids=["days", "hours"])
def test_rolling_matches_a_sliding_frame(spark, target):
    df, _ = history(spark, 2, 24 * 40)
    unique = fills.dedupe_keep_first(df)
    span = 7 * 86_400_000_000
    frame = Window.partitionBy("city_key").orderBy(micros(F.col("datetime"))).rangeBetween(-(span - 1), 0)
    want = {(r[0], r[1]): r[2] for r in unique.select("city_key", "datetime", F.avg("a").over(frame)).collect()}
    got = {(r["city_key"], r["datetime"]): r["a_rolling_7d"]
           for r in rolling.rolling_mean(unique, ["a"], (7, 30), target_rows=target).collect()}
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert (got[k] is None) == (w is None)
        assert w is None or abs(got[k] - w) < 1e-9


def test_rolling_window_is_open_at_its_early_end(spark, table):
    df = table([("x", "2024-01-01 00:00:00", 10.0), ("x", "2024-01-01 00:00:00.000001", 20.0),
                ("x", "2024-01-08 00:00:00", 40.0), ("x", "2024-03-01 00:00:00", None)],
               "city_key string, datetime timestamp_ntz, a double")
    got = [r["a_rolling_7d"] for r in rolling.rolling_mean(df, ["a"], (7,)).orderBy("datetime").collect()]
    assert got == [10.0, 15.0, 30.0, None]


def test_fill_limit_carries_one_step(spark, table):
    df = table([("x", f"2024-01-01 0{h}:00:00", v) for h, v in enumerate([1.0, None, None, 4.0])],
               "city_key string, datetime timestamp_ntz, a double")
    got = fills.fill_forward_limit1(df, ["a"]).orderBy("datetime").collect()
    assert [r["a"] for r in got] == [1.0, 1.0, None, 4.0]


def test_gaps_across_chunks(spark):
    df, frame = history(spark, 2, 200)
    got = quality.temporal_gaps(df, target_rows=20)
    hours = frame.drop_duplicates(["city_key", "datetime"])
    step = hours.groupby("city_key")["datetime"].diff().dropna() / pd.Timedelta(hours=1)
    assert got.agg(F.sum("missing_hours")).first()[0] == int((step - 1).sum())


def test_chunk_numbers_never_decrease(spark):
    df, _ = history(spark, 2, 100, copies=3)
    for target in (7, 2):
        chunked = in_chunks(df, ["city_key"], ("datetime", "_seq"), target).df
        rows = chunked.orderBy("city_key", "datetime", "_seq").select("city_key", "_chunk").collect()
        for before, after in zip(rows, rows[1:]):
            assert before[0] != after[0] or before[1] <= after[1]


def test_quantiles_are_exact(spark):
    rng = random.Random(3)
    rows = [(rng.choice("aaab"), rng.choice([None, 0.0, 5.0, rng.gauss(0, 9)]), float(i)) for i in range(3000)]
    rows += [("c", None, None), ("d", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "k string, u double, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    frame = pd.DataFrame(rows, columns=["k", "u", "v"])
    whole = exact_quantiles(df, ["u", "v"], probs).first()
    for c in ("u", "v"):
        for p in probs:
            assert abs(whole[f"{c}_q{p * 100:g}"] - frame[c].quantile(p)) < 1e-9
    grouped = {r["k"]: r for r in exact_quantiles(df, ["u"], probs, ["k"]).collect()}
    assert set(grouped) == {"a", "b", "c", "d"} and grouped["c"]["u_q50"] is None
    for k in "abd":
        for p in probs:
            assert abs(grouped[k][f"u_q{p * 100:g}"] - frame[frame.k == k]["u"].quantile(p)) < 1e-9
