"""Rank correlation, time series, tests and models against straight versions of them."""

import random
from datetime import datetime, timedelta
from fractions import Fraction
from math import comb, erfc, exp, pi, sqrt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aeroweave.functions import special
from aeroweave.operators import arima, boosting, clusters, hypotheses, neighbours, outliers, regression, spearman, timeseries
from aeroweave.plans import cells, ranks
from aeroweave.plans.graphs import components

T0 = datetime(2024, 1, 1)


def histories(spark, values, step=timedelta(hours=1)):
    """{key: values} as rows in random order, a null where the value is None."""
    rows = [(k, T0 + i * step, None if v is None else float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "city_key string, datetime timestamp_ntz, v double")


# Ranks

@pytest.mark.parametrize("partitions", [1, 5])
def test_ranks_with_ties_equal_pandas(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), float(rng.choice([1, 2, 2.5, 7, -0.0, 0.0, rng.randrange(90)]))) for _ in range(400)] + [("a", 2.0)] * 300
    frame = pd.DataFrame(rows, columns=["g", "v"])
    want = frame.assign(r=frame.groupby("g")["v"].rank())
    counts = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {(r["g"], r["v"]): r["rank"] for r in ranks.average_ranks(counts, ["g"], "v").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == {(g, v): r for g, v, r in want.itertuples(index=False)}


@pytest.mark.parametrize("hot", [10_000, 20])
def test_spearman_equals_pandas_pair_by_pair(spark, monkeypatch, hot):
    monkeypatch.setattr(ranks, "HOT_ROWS", hot)
    rng = random.Random(2)
    rows = [tuple(None if rng.random() < gap else float(rng.randrange(span)) for gap, span in ((0.0, 9), (0.2, 50), (0.5, 4), (0.0, 1)))
            for _ in range(300)] + [(3.0, 7.0, 1.0, 0.0)] * 200 + [(float("nan"), 1.0, 2.0, 0.0)]
    frame = pd.DataFrame(rows, columns=list("wxyz"))
    want = frame.corr(method="spearman")
    for row in spearman.spearman_matrix(spark.createDataFrame(rows, "w double, x double, y double, z double"), list("wxyz")).collect():
        expected = want.loc[row["x"], row["y"]]
        assert (row["rho"] is None and np.isnan(expected)) or abs(row["rho"] - expected) < 1e-9, row
        assert row["n"] == (frame[row["x"]].notna() & frame[row["y"]].notna()).sum()


def test_spearman_of_groups_without_rows_or_keys(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 9.0), (None, 3.0, None), (None, 4.0, None)], "g string, x double, y double")
    got = {r["g"]: (r["rho"] and round(r["rho"], 12), r["n"]) for r in spearman.rank_correlations(df, [("x", "y")], ["g"]).collect()}
    assert got == {"a": (1.0, 2), None: (None, 0)}
    assert spearman.rank_correlations(df.limit(0), [("x", "y")]).collect() == []


# Time series

def slow_acf(x, lags):
    x = np.asarray([v for v in x if v is not None]) - np.mean([v for v in x if v is not None])
    return [float(x[k:] @ x[:len(x) - k] / (x @ x)) if k < len(x) else None for k in range(1, lags + 1)]


def slow_pacf(r):
    """Last coefficient of each order's Yule-Walker equations."""
    full = [1.0, *r]
    found = []
    for k in range(1, len(r) + 1):
        matrix = np.array([[full[abs(i - j)] for j in range(k)] for i in range(k)])
        found.append(float(np.linalg.solve(matrix, full[1:k + 1])[-1]))
    return found


@pytest.mark.parametrize("target", [500_000, 30, 1], ids=["single", "chunks", "ranges"])
def test_autocorrelation_at_any_chunk_size(spark, target):
    rng = np.random.default_rng(1)
    walk = np.cumsum(rng.normal(size=120)).tolist()
    walk[7] = walk[60] = None
    got = timeseries.autocorrelation(histories(spark, {"a": walk, "b": [1.0] * 9, "c": [1.0, 2.0, 4.0]}), "v", lags=12, target_rows=target)
    rows = {(r["city_key"], r["lag"]): r for r in got.collect()}
    acf = slow_acf(walk, 12)
    for k, (r, p) in enumerate(zip(acf, slow_pacf(acf)), 1):
        assert abs(rows["a", k]["acf"] - r) < 1e-12 and abs(rows["a", k]["pacf"] - p) < 1e-9 and rows["a", k]["n"] == 118
    assert all(rows["b", k]["acf"] is None and rows["b", k]["pacf"] is None for k in range(1, 13))
    assert [rows["c", k]["acf"] is None for k in (1, 2, 3, 12)] == [False, False, True, True]


@pytest.mark.parametrize("target", [500_000, 1], ids=["one span", "many"])
@pytest.mark.parametrize("period", [6, 7])
def test_decomposition_at_any_span(spark, target, period):
    rng = np.random.default_rng(2)
    values = [float(3 * t + 10 * np.sin(2 * np.pi * t / period) + rng.normal()) for t in range(90)]
    values[40] = None
    df = histories(spark, {"a": values, "short": values[:period - 1]})
    df = df.unionByName(df.filter("city_key = 'a'").limit(5))  # a step of several equal values
    got = {(r["city_key"], int((r["datetime"] - T0).total_seconds() // 3600)): r
           for r in timeseries.decompose(df, "v", period, target_rows=target).collect()}
    assert len(got) == 89 + period - 1 and ("a", 40) not in got
    half, trend = period // 2, {}
    weights = [0.5, *[1.0] * (period - 1), 0.5] if period % 2 == 0 else [1.0] * period
    for t in range(half, 90 - half):
        window = values[t - half:t + half + 1]
        if None not in window:
            trend[t] = float(np.dot(weights, window)) / period
    hour0 = int((T0 - datetime(1970, 1, 1)).total_seconds() // 3600)
    phase = lambda t: (hour0 + t) % period
    means = {p: np.mean([values[t] - trend[t] for t in trend if phase(t) == p]) for p in range(period)}
    for t in range(90):
        if t != 40:
            row = got["a", t]
            season = means[phase(t)] - np.mean(list(means.values()))
            assert abs(row["seasonal"] - season) < 1e-9
            assert (row["trend"] is None) == (t not in trend)
            if t in trend:
                assert abs(row["trend"] - trend[t]) < 1e-9 and abs(row["trend"] + row["seasonal"] + row["residual"] - values[t]) < 1e-9
    assert all(got["short", t]["trend"] is None and got["short", t]["seasonal"] is None for t in range(period - 1))


@pytest.mark.parametrize("target", [500_000, 25, 1], ids=["single", "chunks", "ranges"])
def test_stationarity_tests_equal_straight_versions(spark, target):
    rng = np.random.default_rng(3)
    noise, walk = rng.normal(size=150), np.cumsum(rng.normal(size=150))
    df = histories(spark, {"noise": noise, "walk": walk, "flat": [2.0] * 20, "tiny": [1.0, 2.0]})
    found = {r["city_key"]: r for r in timeseries.kpss(df, "v", lags=6, target_rows=target).collect()}
    tested = {r["city_key"]: r for r in timeseries.adf(df, "v", lags=2, target_rows=target).collect()}
    for name, x in (("noise", noise), ("walk", walk)):
        e = x - x.mean()
        n = len(x)
        variance = (e @ e + 2 * sum((1 - k / 7) * (e[k:] @ e[:-k]) for k in range(1, 7))) / n
        assert abs(found[name]["statistic"] - np.sum(np.cumsum(e) ** 2) / n**2 / variance) < 1e-9
        dx = np.diff(x)
        y = dx[2:]
        matrix = np.column_stack([np.ones(len(y)), x[2:-1], dx[1:-1], dx[:-2]])
        beta, *_ = np.linalg.lstsq(matrix, y, rcond=None)
        error = np.sum((y - matrix @ beta) ** 2) / (len(y) - 4)
        t = beta[1] / np.sqrt(error * np.linalg.inv(matrix.T @ matrix)[1, 1])
        assert abs(tested[name]["statistic"] - t) < 1e-8 and tested[name]["n"] == len(y)
    assert found["noise"]["stationary"] and not found["walk"]["stationary"]
    assert tested["noise"]["stationary"] and not tested["walk"]["stationary"]
    assert found["flat"]["statistic"] is None and tested["flat"]["statistic"] is None and tested["tiny"]["statistic"] is None


# ARIMA

def slow_arima(x, p, d, q):
    """Gauss-Newton with halved steps, errors one after the other and derivatives by complex steps."""
    w = np.diff(np.asarray(x, float), d)

    def errors(beta):
        found = []
        for t in range(p, len(w)):
            e = w[t] - beta[0] - sum(beta[1 + i] * w[t - 1 - i] for i in range(p))
            e -= sum(beta[1 + p + j] * found[-1 - j] for j in range(q) if j < len(found))
            found.append(e)
        return np.array(found)

    beta = np.zeros(1 + p + q)
    for _ in range(200):
        base = errors(beta)
        slopes = np.column_stack([errors(beta + 1e-30j * np.eye(len(beta))[i]).imag / 1e-30 for i in range(len(beta))])
        step, scale = -np.linalg.lstsq(slopes, base, rcond=None)[0], 1.0
        while scale > 1e-10 and np.sum(errors(beta + scale * step) ** 2) > np.sum(base**2):
            scale /= 2
        beta = beta + scale * step
        if np.abs(step).max() < 1e-12:
            break
    return beta, errors(beta)


def simulated(n, p, d, q, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n)
    w = np.zeros(n)
    for t in range(n):
        w[t] = 0.3 + e[t] + (0.5 * w[t - 1] if p and t else 0.0) + (0.4 * e[t - 1] if q and t else 0.0) + (0.2 * e[t - 2] if q > 1 and t > 1 else 0)
    for _ in range(d):
        w = np.cumsum(w)
    return w


@pytest.mark.parametrize("order, target, ahead", [((1, 1, 1), 60, True), ((0, 0, 2), 500_000, False), ((1, 2, 0), 500_000, True)])
def test_arima_equals_a_sequential_fit(spark, order, target, ahead):
    x = simulated(220, *order, seed=sum(order))
    df = histories(spark, {"a": x})
    beta, errors = slow_arima(x, *order)
    rows = {r["term"]: r for r in arima.arima(df, "v", order, target_rows=target).collect()}
    p, d, q = order
    names = ["const", *[f"ar{i + 1}" for i in range(p)], *[f"ma{i + 1}" for i in range(q)]]
    assert rows["const"]["converged"] and rows["const"]["n"] == len(errors)
    for name, value in zip(names, beta):
        assert abs(rows[name]["coefficient"] - value) < 1e-6, (name, rows[name], value)
    assert abs(rows["const"]["sigma2"] - np.mean(errors**2)) < 1e-9
    if not ahead:
        return
    # the forecast carries on from the last values and errors
    w = np.diff(x, d)
    past, last, levels = list(w[::-1][:p]), list(errors[::-1][:q]), [np.diff(x, i)[-1] for i in range(d)]
    ahead = arima.forecast(df, "v", order, steps=4, target_rows=target).orderBy("step").collect()
    for step, row in enumerate(ahead, 1):
        value = beta[0] + sum(b * v for b, v in zip(beta[1:], past)) + sum(b * v for b, v in zip(beta[1 + p:], last))
        past, last = [value, *past][:p], [0.0, *last][:q]
        for i in reversed(range(d)):
            levels[i] += value
            value = levels[i]
        assert row["step"] == step and row["datetime"] == T0 + timedelta(hours=219 + step) and abs(row["forecast"] - value) < 1e-4


def test_recursions_by_doubling(spark):
    rng = np.random.default_rng(5)
    for theta in ([0.5], [-0.9], [0.4, 0.3], [1.2, 0.7], [0.1, -0.2, 0.3]):
        u, z = rng.normal(size=300), []
        for t in range(300):
            z.append(u[t] - sum(c * z[t - 1 - j] for j, c in enumerate(theta) if t - 1 - j >= 0))
        assert np.abs(arima.recursive(u, np.array(theta)) - z).max() < 1e-9
    with pytest.raises(ValueError):
        arima.arima(histories(spark, {"a": [1.0, 2.0]}), "v", (0, 1, 0))


def test_arima_of_short_and_constant_histories(spark):
    df = histories(spark, {"short": [1.0, 2.0], "flat": [3.0] * 30, "gaps": [None] * 5})
    got = arima.arima(df, "v", (1, 1, 1)).collect()
    assert {r["city_key"] for r in got} == {"flat"} and all(abs(r["coefficient"]) < 1e-9 for r in got if r["term"] == "const")


# Tails

def test_tails_equal_closed_forms():
    for n in (2, 5, 20, 60):
        for k in range(1, n + 1):
            for x in (Fraction(1, 50), Fraction(1, 3), Fraction(9, 10)):  # a binomial tail is an incomplete beta
                want = float(sum(comb(n, j) * x**j * (1 - x) ** (n - j) for j in range(k, n + 1)))
                assert abs(special.incomplete_beta(k, n - k + 1, float(x)) - want) < 1e-12 + 1e-11 * want
    for a in (1, 3, 10, 40):
        for x in (0.1, 1.0, 9.5, 60.0):  # a Poisson head is an incomplete gamma
            term, want = exp(-x), 0.0
            for j in range(a):
                want += term
                term *= x / (j + 1)
            assert abs(special.upper_gamma(a, x) - want) < 1e-12 + 1e-10 * want
    for x in (0.2, 1.0, 3.84, 30.0):
        assert abs(special.chi_square_tail(x, 1) - erfc(sqrt(x / 2))) < 1e-12
    for t in (0.0, 0.5, 2.0, 40.0):
        assert abs(special.t_tail(t, 1) - (1 - 2 / pi * np.arctan(t))) < 1e-10  # one degree of freedom is Cauchy's
        assert abs(special.t_tail(t, 2) - (1 - t / sqrt(2 + t * t))) < 1e-10
        assert abs(special.f_tail(t * t, 1, 7) - special.t_tail(t, 7)) < 1e-12
    assert special.t_tail(float("inf"), 3) == 0.0 and special.f_tail(0.0, 2, 2) == 1.0 and np.isnan(special.t_tail(float("nan"), 3))


# Group tests

def test_group_tests_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(str(g), float(rng.normal(g, 1 + g)), float(i % 3)) for g in range(3) for i in range(20 + 5 * g)]
    rows += [("0", None, 1.0), (None, 1.0, 1.0), ("9", 4.0, 1.0), ("0", float("nan"), None)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    groups = [np.array([r[1] for r in rows if r[0] == k and r[1] is not None and not np.isnan(r[1])]) for k in "0129"]
    grand, n = np.concatenate(groups).mean(), sum(map(len, groups))
    between = sum(len(x) * (x.mean() - grand) ** 2 for x in groups)
    within = sum(((x - x.mean()) ** 2).sum() for x in groups)
    row = {r["measure"]: r for r in hypotheses.anova(df, ["a", "b"], "g").collect()}["a"]
    f = between / 3 / (within / (n - 4))
    assert abs(row["statistic"] - f) < 1e-9 and (row["between"], row["within"], row["groups"]) == (3, n - 4, 4)
    assert abs(row["p_value"] - special.f_tail(f, 3, n - 4)) < 1e-12
    t = {r["measure"]: r for r in hypotheses.t_tests(df, ["a", "b"], "g", "0", "1").collect()}["a"]
    e = [x.var(ddof=1) / len(x) for x in groups[:2]]
    assert abs(t["statistic"] - (groups[0].mean() - groups[1].mean()) / sqrt(sum(e))) < 1e-9
    assert abs(t["freedom"] - sum(e) ** 2 / sum(v * v / (len(x) - 1) for v, x in zip(e, groups))) < 1e-9
    lone = {r["measure"]: r for r in hypotheses.t_tests(df, ["a"], "g", "0", "9").collect()}["a"]
    assert lone["statistic"] is None and lone["p_value"] is None and lone["n_second"] == 1
    assert len([r for r in hypotheses.group_tests(df, ["a"], "g").collect() if r["test"] == "t"]) == 6


def test_chi_square_counts_empty_cells(spark):
    rows = [("x", "p")] * 8 + [("x", "q")] * 2 + [("y", "q")] * 9 + [("z", "p")] * 1 + [(None, "p"), ("x", None)]
    got = hypotheses.chi_square_tests(spark.createDataFrame(rows, "a string, b string"), [("a", "b")]).first()
    observed = np.array([[8, 2], [0, 9], [1, 0]], float)
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / 20
    statistic = ((observed - expected) ** 2 / expected).sum()
    assert abs(got["statistic"] - statistic) < 1e-9 and got["freedom"] == 2 and got["n"] == 20
    assert abs(got["p_value"] - exp(-statistic / 2)) < 1e-12
    flat = hypotheses.chi_square_tests(spark.createDataFrame([("x", "p"), ("x", "q")], "a string, b string"), [("a", "b")]).first()
    assert flat["statistic"] is None and flat["p_value"] is None


# Regression

@pytest.mark.parametrize("parts", [1, 40])
def test_ill_conditioned_polynomial_keeps_its_digits(spark, parts):
    rng = np.random.default_rng(6)
    x = 1000 + rng.uniform(0, 10, 300).round(2)
    y = 2.0 + 0.5 * (x - 1005) + 0.25 * (x - 1005) ** 2 + rng.normal(0, 0.1, 300).round(3)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (1.0, float("nan"))], "x double, y double")
    got, summary = regression.polynomial_regression(df.repartition(parts), "y", ["x"], degree=2)
    rows = {r["term"]: r for r in got.collect()}
    # exact normal equations
    xs, ys = [[Fraction(float(v)) ** k for k in range(3)] for v in x], [Fraction(float(v)) for v in y]
    a = [[sum(r[i] * r[j] for r in xs) for j in range(3)] + [sum(r[i] * v for r, v in zip(xs, ys))] for i in range(3)]
    for i in range(3):
        for j in range(3):
            if j != i:
                factor = a[j][i] / a[i][i]
                a[j] = [p - factor * q for p, q in zip(a[j], a[i])]
    for i, term in enumerate(("const", "x", "x^2")):
        want = float(a[i][3] / a[i][i])
        assert abs(rows[term]["coefficient"] - want) < 1e-7 * abs(want), term
    assert rows["x"]["vif"] > 1e4 and rows["const"]["vif"] is None
    assert summary.first()["n"] == 300


def test_regression_diagnostics_equal_numpy_per_group(spark):
    rng = np.random.default_rng(8)
    rows = []
    for g in ("a", None):
        for _ in range(60):
            u, v = rng.normal(size=2)
            rows.append((g, float(u), float(v), float(1 + u - 2 * v + u * v + rng.normal() * (1 + abs(u)))))
    rows += [("few", 1.0, 2.0, 3.0)] * 4 + [("same", 1.0, 2.0, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, u double, v double, y double")
    got, summary = regression.polynomial_regression(df, "y", ["u", "v"], 2, by=["g"])
    rows_of = {(r["g"], r["term"]): r for r in got.collect()}
    totals = {r["g"]: r for r in summary.collect()}
    assert {k[0] for k in rows_of} == {"a", None} and totals["few"]["r2"] is None and totals["same"]["n"] == 30
    for g in ("a", None):
        data = np.array([r[1:] for r in rows if r[0] == g])
        u, v, y = data.T
        m = np.column_stack([np.ones(60), u, v, u * u, u * v, v * v])
        beta, *_ = np.linalg.lstsq(m, y, rcond=None)
        e = y - m @ beta
        s2, inverse = e @ e / 54, np.linalg.inv(m.T @ m)
        for i, term in enumerate(("const", "u", "v", "u^2", "u*v", "v^2")):
            row = rows_of[g, term]
            assert abs(row["coefficient"] - beta[i]) < 1e-9 and abs(row["std_error"] - np.sqrt(s2 * inverse[i, i])) < 1e-9
            if i:
                others = np.delete(m, i, axis=1)
                left = m[:, i] - others @ np.linalg.lstsq(others, m[:, i], rcond=None)[0]
                assert abs(row["vif"] - np.sum((m[:, i] - m[:, i].mean()) ** 2) / (left @ left)) < 1e-6
        squares = e * e
        left = squares - m @ np.linalg.lstsq(m, squares, rcond=None)[0]
        spread = 60 * (1 - left @ left / np.sum((squares - squares.mean()) ** 2))
        assert abs(totals[g]["bp_statistic"] - spread) < 1e-7 and abs(totals[g]["rmse"] - np.sqrt(e @ e / 60)) < 1e-9


# Trees

def boosted_rows(spark, n=400):
    rng = random.Random(9)
    rows = [(T0 + timedelta(hours=i), float(rng.randrange(40)), None if rng.random() < 0.1 else rng.random(), 0.0) for i in range(n)]
    rows = [(t, a, b, (3.0 if a > 20 else 0.0) + (b or 0.5) * 2 + rng.random() * 0.1) for t, a, b, _ in rows]
    return spark.createDataFrame(rows, "datetime timestamp_ntz, a double, b double, y double")


def slow_boost(bins, y, trees, depth, rate, min_leaf):
    """Rows split one node after the other, all cuts tried."""
    base = round(sum(y) / len(y))
    total = [base] * len(y)
    for _ in range(trees):
        rest = [a - b for a, b in zip(y, total)]
        nodes = [list(range(len(y)))]
        for level in range(depth):
            after = []
            for rows in nodes:
                best = None
                n, s = len(rows), sum(rest[i] for i in rows)
                for f in range(len(bins[0])):
                    for cut in range(boosting.BINS - 1):
                        left = [i for i in rows if bins[i][f] <= cut]
                        if min_leaf <= len(left) <= n - min_leaf:
                            sl = sum(rest[i] for i in left)
                            gain = float(sl) ** 2 / len(left) + float(s - sl) ** 2 / (n - len(left)) - float(s) ** 2 / n
                            if gain > 1e-9 * float(s) ** 2 / n and gain > 0 and (best is None or gain > best[0]):
                                best = gain, f, cut
                if best is None:
                    after += [rows, []]
                else:
                    after += [[i for i in rows if bins[i][best[1]] <= best[2]], [i for i in rows if bins[i][best[1]] > best[2]]]
            nodes = after
        for rows in nodes:
            leaf = round(rate * sum(rest[i] for i in rows) / len(rows)) if rows else 0
            for i in rows:
                total[i] += leaf
    return base, total


def test_boosted_trees_equal_a_row_by_row_version_at_any_partitioning(spark):
    df = boosted_rows(spark)
    data = boosting.binned(df, "y", ["a", "b"], "datetime", 2)
    models = boosting.train(data, 3, 2, 0.5, min_leaf=10)
    again = boosting.train(boosting.binned(df.repartition(7), "y", ["a", "b"], "datetime", 2), 3, 2, 0.5, min_leaf=10)
    for (base, grown), (other, regrown) in zip(models, again):
        assert base == other and all((x == z).all() for a, b in zip(grown, regrown) for x, z in zip(a, b))
    rows = data.rows.collect()
    for fold, (base, grown) in enumerate(models):
        own = [r for r in rows if r["span"] <= fold]
        want_base, want = slow_boost([r["bins"] for r in own], [r["y"] for r in own], 3, 2, 0.5, 10)
        assert base == want_base and boosting.predict(base, grown, np.array([r["bins"] for r in own]), 2).tolist() == want


def test_folds_look_back_and_beat_the_mean(spark):
    got = boosting.boosted_folds(boosted_rows(spark), "y", ["a", "b"], "datetime", folds=3, trees=8).orderBy("fold").collect()
    assert [(r["fold"], r["train_rows"] + r["test_rows"]) for r in got] == [(1, 200), (2, 300), (3, 400)]
    assert all(r["rmse"] < 0.5 * r["mean_rmse"] and r["r2"] > 0.7 and r["mae"] <= r["rmse"] for r in got)
    empty = boosting.boosted_folds(boosted_rows(spark).limit(0), "y", ["a", "b"], "datetime", folds=2, trees=1).collect()
    assert [(r["test_rows"], r["rmse"]) for r in empty] == [(0, None)] * 2


def test_isolation_forest_finds_planted_rows_at_any_partitioning(spark):
    rng = np.random.default_rng(10)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(400, 2)))]
    rows += [(1000 + i, 9.0 + i, -9.0 - i) for i in range(3)] + [(2000 + i, 0.1, 0.1) for i in range(250)] + [(3000, None, 1.0)]
    df = spark.createDataFrame(rows, "event_id long, a double, b double")
    first = {r["event_id"]: r["anomaly_score"] for r in outliers.isolation_scores(df, ["a", "b"], trees=40, sample=64).collect()}
    second = {r["event_id"]: r["anomaly_score"] for r in outliers.isolation_scores(df.repartition(9), ["a", "b"], trees=40, sample=64).collect()}
    assert first == second and first.pop(3000) is None
    assert set(sorted(first, key=first.get)[-3:]) == {1000, 1001, 1002} and first[1002] > 0.6 and first[2000] < 0.5
    assert outliers.isolation_scores(df.limit(1), ["a", "b"]).first()["anomaly_score"] is None


# Cells

def slow_neighbours(rows, k):
    donors = [r for r in rows if None not in r[1:]]
    spread = [float(np.std([r[i] for r in donors])) for i in (1, 2)]
    found = {}
    for i, a, b, t in rows:
        if t is None and a is not None and b is not None:
            apart = sorted((sum(((x - y) / s) ** 2 for x, y, s in zip((a, b), d[1:3], spread) if s > 0), d[3]) for d in donors)
            last = apart[min(k, len(apart)) - 1][0]
            found[i] = float(np.mean([t for d, t in apart if d <= last]))
        else:
            found[i] = t
    return found


def test_neighbours_equal_brute_force_with_a_dense_cell(spark, monkeypatch):
    monkeypatch.setattr(cells, "LEAF_POINTS", 4)
    rng = random.Random(11)
    spot = lambda: (rng.uniform(0, 100), rng.uniform(0, 9)) if rng.random() < 0.4 else (50 + rng.random() / 1000, 4 + rng.random() / 1000)
    rows = [(i, *spot(), None if rng.random() < 0.3 else float(rng.randrange(100))) for i in range(300)]
    rows += [(400 + i, 50.0, 4.0, 7.0) for i in range(100)] + [(600, None, 1.0, None), (601, 1.0, None, 5.0), (602, -500.0, 99.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, t double")
    got = {r["id"]: r["t_filled"] for r in neighbours.impute_by_neighbours(df, "t", ["a", "b"], 3).collect()}
    want = slow_neighbours(rows, 3)
    assert got.keys() == want.keys()
    assert all((got[i] is None and want[i] is None) or abs(got[i] - want[i]) < 1e-9 for i in want), [(i, got[i], want[i]) for i in want if got[i] != want[i]][:4]
    one_place = [(1, 1.0, 1.0, 4.0), (2, 1.0, 1.0, 8.0), (3, 1.0, 1.0, None)]
    flat = neighbours.impute_by_neighbours(spark.createDataFrame(one_place, "id long, a double, b double, t double"), "t", ["a", "b"]).collect()
    assert {r["id"]: r["t_filled"] for r in flat} == {1: 4.0, 2: 8.0, 3: 6.0}
    assert neighbours.impute_by_neighbours(df.limit(0), "t", ["a", "b"]).collect() == []


def slow_clusters(rows, eps, least):
    near = [[j for j, s in enumerate(rows) if (r[1] - s[1]) ** 2 + (r[2] - s[2]) ** 2 <= eps * eps] for r in rows]
    core = [len(n) >= least for n in near]
    label = {}
    for i in sorted(range(len(rows)), key=lambda i: rows[i][0]):
        if core[i] and i not in label:
            stack = [i]
            while stack:
                at = stack.pop()
                if at not in label:
                    label[at] = rows[i][0]
                    stack += [j for j in near[at] if core[j]]
    found = {}
    for i, r in enumerate(rows):
        reach = [label[j] for j in near[i] if core[j]]
        found[r[0]] = (label[i], "core") if core[i] else (min(reach), "border") if reach else (None, "noise")
    return found


@pytest.mark.parametrize("direct", [32, 1])
def test_density_clusters_equal_brute_force(spark, monkeypatch, direct):
    monkeypatch.setattr(clusters, "DIRECT_POINTS", direct)
    monkeypatch.setattr(cells, "LEAF_POINTS", 4)
    rng = random.Random(12)
    rows = [(i, rng.uniform(0, 12), rng.uniform(0, 12)) for i in range(150)]
    rows += [(200 + i, 3 + rng.gauss(0, 0.2), 3 + rng.gauss(0, 0.2)) for i in range(80)] + [(300 + i, 9.0, 9.0) for i in range(50)]
    rows += [(400 + i, float(i % 6) - 20, float(i // 6)) for i in range(30)]  # a lattice whose neighbours are just in reach
    df = spark.createDataFrame([*rows, (999, None, 1.0)], "event_id long, x double, y double")
    got = {r["event_id"]: (r["cluster"], r["cluster_role"]) for r in clusters.density_clusters(df, ["x", "y"], 1.0, 5).collect()}
    assert got.pop(999) == (None, None)
    want = slow_clusters(rows, 1.0, 5)
    assert got == want, [(i, got[i], want[i]) for i in want if got[i] != want[i]][:5]
    assert clusters.density_clusters(df.limit(0), ["x", "y"], 1.0).collect() == []


@pytest.mark.parametrize("base", [0, 1])
def test_density_clusters_look_into_undecided_parts(spark, monkeypatch, base):
    monkeypatch.setattr(clusters, "BASE", base)
    monkeypatch.setattr(clusters, "DIRECT_POINTS", 2)
    rng = random.Random(13)
    clump = lambda start, x, y: [(start + i, x + rng.gauss(0, 0.12), y + rng.gauss(0, 0.12)) for i in range(40)]
    rows = clump(0, 0.3, 0.3) + clump(100, 1.75, 0.3) + clump(200, -0.2, -3.1) + clump(300, 1.25, -3.1)
    rows += [(400 + i, rng.uniform(-2, 4), rng.uniform(-5, 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "event_id long, x double, y double")
    got = {r["event_id"]: (r["cluster"], r["cluster_role"]) for r in clusters.density_clusters(df, ["x", "y"], 1.0, 12).collect()}
    assert got == slow_clusters(rows, 1.0, 12)
    assert {role for _, role in got.values()} == {"core", "border", "noise"}


def test_density_clusters_hold_points_once(spark, monkeypatch):
    sizes, write = {}, clusters.written
    def counting(df, label):
        table = write(df, label)
        sizes[len(sizes), label] = table.count()
        return table
    monkeypatch.setattr(clusters, "written", counting)
    df = spark.range(6000).selectExpr("id as event_id", "id * 0.002 as x", "id * 0.0005 as y")
    got = clusters.density_clusters(df, ["x", "y"], 1.0).groupBy("cluster", "cluster_role").count().collect()
    assert [tuple(r) for r in got] == [(0, "core", 6000)]
    assert len([n for n in sizes.values() if n >= 1000]) == 1, sizes


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 301)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 300: 300, 301: 300}
