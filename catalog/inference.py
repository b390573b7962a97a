"""Rank correlation, time-series analysis, tests and models of the study."""

from __future__ import annotations

from itertools import combinations, combinations_with_replacement

from pyspark.sql import functions as F

from aeroweave.operators import arima, boosting, clusters, hypotheses, neighbours, outliers, regression, spearman, stats, timeseries
from aeroweave.plans.chunks import HOUR_US
from catalog.entry import Entry, entry, rounded
from catalog.relations import r6, season
from catalog.study import STUDY, _cell, _det, _n, _r

RANKED_CITY = [(x, y) for x in ("no2", "pm10", "o3") for y in ("temperature", "traffic_index")]
LAGGED_PREDICTORS = ("temperature", "pressure", "traffic_index")
LAGS = (0, 1, 3, 6, 12, 24)


def _spearman_sql(pairs, relation: str, by: str = "") -> str:
    """Ranks with ties averaged, over the rows that know both sides."""
    head, part = (f"{by}, ", f"partition by {by} ") if by else ("", "")
    also = f", {by}" if by else ""

    def rank(c: str) -> str:
        return f"rank() over ({part}order by {c}) + (count(*) over (partition by {c}{also}) - 1) / 2.0"

    return " union all ".join(
        f"""select {head}'{x}' as x, '{y}' as y,
            covar_pop(rx, ry) / nullif(stddev_pop(rx) * stddev_pop(ry), 0) as rho, count(*) as n
        from (select {head}{rank(x)} as rx, {rank(y)} as ry from {relation} where {x} is not null and {y} is not null)
        {f'group by {by}' if by else ''}""" for x, y in pairs)


HALF = [*((c, c) for c in STUDY), *combinations(STUDY, 2)]
# an additional column of a single value, and one with gaps
# means differ in their last digits by the order of adding up, which would part ties
STEADY = f"select * replace ({', '.join(f'{r6(c)} as {c}' for c in STUDY)}) from study"
FLAT = "select *, 7.0::double as flat, case when day_of_week = 2 then null else round(no2, 0) end as gappy from steady"
FLAT_COLUMNS = ("no2", "flat", "gappy", "temperature")
FLAT_HALF = [*((c, c) for c in FLAT_COLUMNS), *combinations(FLAT_COLUMNS, 2)]


def _both_ways(half: str) -> str:
    return f"""with half as ({half}) select x, y, rho, n from half
        union all select y as x, x as y, rho, n from half where x <> y"""


def _steady(t):
    return rounded(t.study, " ".join(STUDY))


def _gaps(t):
    return _steady(t).withColumns({
        "flat": F.lit(7.0), "gappy": F.when(F.col("day_of_week") != 2, F.round("no2", 0))})


def _lagged_sql() -> str:
    parts = []
    for c in LAGGED_PREDICTORS:
        for n in LAGS:
            lagged = f"lag({c}, {n}) over (partition by city_key order by datetime)" if n else c
            parts += [f"""select '{c}' as predictor, '{p}' as pollutant, {n} as lag, {_r('x', p)} as r, {_n('x', p)} as n
                from (select {p}, {lagged} as x from hourly)""" for p in stats.POLLUTANTS]
    return " union all ".join(parts)


def _seasonal_sql() -> str:
    return " union all ".join(
        f"""select season, '{x}' as x, '{y}' as y, {_r(x, y)} as r, {_n(x, y)} as n
        from (select * replace ({season('month(date)')} as season) from study) group by season""" for x, y in stats.TESTED_PAIRS)


# daily series without gaps, three keys
MARKETS = """select 'm' || (ascii(right(city, 1)) % 3) as city_key, cast(date as timestamp) as datetime, no2, pm10 from shipments"""
DAY_US = 24 * HOUR_US
PERIOD = 7


def _markets(t):
    return t.shipments.select(
        F.concat(F.lit("m"), (F.ascii(F.right("city", F.lit(1))) % 3).cast("string")).alias("city_key"),
        F.col("date").cast("timestamp_ntz").alias("datetime"), "no2", "pm10")


def _daily(t):
    return _markets(t).groupBy("city_key", "datetime").agg(F.avg("no2").alias("no2"))


DAILY_SERIES = "select city_key, datetime, avg(no2) as no2 from markets group by 1, 2"
CENTRED = """select city_key, {v} - avg({v}) over (partition by city_key) as x, count(*) over (partition by city_key) as n,
    row_number() over (partition by city_key order by datetime) as i from {r} where {v} is not null"""


def _products(lags: int) -> str:
    """Sums of lagged products per key as one list, lag 0 first."""
    return f"""select city_key, n, list(c order by k) as c from (
        select a.city_key, a.n, k, coalesce(sum(a.x * b.x), 0) as c
        from range(0, {lags + 1}) lags(k) join centred a on true left join centred b on a.city_key = b.city_key and b.i = a.i - k
        group by all) group by all"""


ACF_LAGS = 48
ACF_SQL = f"""with recursive acf as (
    select city_key, n, list_transform(c[2:], lambda v: v / c[1]) as r from products),
steps as (
    select city_key, r, 1 as k, [r[1]] as phi from acf
    union all
    select city_key, r, k + 1, list_transform(range(1, k + 1), lambda j: phi[j] - step * phi[k + 1 - j]) || [step] from (
        select *, (r[k + 1] - list_dot_product(phi, list_reverse(r[1:k]))) / (1 - list_dot_product(phi, r[1:k])) as step
        from steps where k < {ACF_LAGS}))
select s.city_key, s.k as lag, s.r[s.k] as acf, s.phi[s.k] as pacf, 1.96 / sqrt(n) as bound, n
from steps s join acf using (city_key)"""

KPSS_LAGS = 24
KPSS_SQL = f"""select city_key, squares / (n::double * n * v) as statistic, v as long_run_variance, n,
    squares / (n::double * n * v) < 0.463 as stationary
from (select city_key, n, (c[1] + 2 * list_sum(list_transform(range(1, {KPSS_LAGS + 1}),
        lambda k: c[k + 1] * (1 - k / {KPSS_LAGS + 1}.0)))) / n as v from products)
join (select city_key, sum(s * s) as squares from (
    select city_key, sum(x) over (partition by city_key order by i) as s from centred) group by city_key) using (city_key)"""

ADF_TERMS = ("l1", "d1", "d2")


def _adf_sql() -> str:
    size = len(ADF_TERMS)
    moments = [f"covar_pop({ADF_TERMS[i]}, {ADF_TERMS[j]}) as s{i}{j}" for i in range(size) for j in range(i, size)]
    crossed = [f"covar_pop({x}, d0) as t{i}" for i, x in enumerate(ADF_TERMS)]
    grid = [[_cell(i, j) for j in range(size)] for i in range(size)]
    solved = [f"{_det([[f't{i}' if j == k else grid[i][j] for j in range(size)] for i in range(size)])} / {_det(grid)} as b{k}"
              for k in range(size)]
    minor = _det([row[1:] for row in grid[1:]])
    explained = " + ".join(f"b{k} * t{k}" for k in range(size))
    return f"""select city_key, b0 / sqrt(error * inverse / n) as statistic, b0 as coefficient, n,
        -2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.040 / n ** 3 as critical_5,
        b0 / sqrt(error * inverse / n) < -2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.040 / n ** 3 as stationary
    from (select *, (yy - ({explained})) * n / (n - {size} - 1) as error from (
        select *, {minor} / {_det(grid)} as inverse, {', '.join(solved)} from (
            select city_key, count(*) as n, var_pop(d0) as yy, {', '.join([*moments, *crossed])} from (
                select city_key, x - l1 as d0, l1, l1 - l2 as d1, l2 - l3 as d2 from (
                    select city_key, x, lag(x) over w as l1, lag(x, 2) over w as l2, lag(x, 3) over w as l3 from centred
                    window w as (partition by city_key order by i)) where l3 is not null) group by city_key)))"""


DECOMPOSED = f"""with spread as (
    select city_key, datetime, no2 as observed, epoch(datetime)::bigint // 86400 % {PERIOD} as phase, count(*) over w as k, avg(no2) over w as t
    from daily window w as (partition by city_key order by datetime
        range between interval {PERIOD // 2} day preceding and interval {PERIOD // 2} day following)),
trended as (select city_key, datetime, observed, phase, case when k = {PERIOD} then t end as trend from spread),
phases as (select city_key, phase, avg(observed - trend) as s from trended where trend is not null group by all),
seasons as (select city_key, phase, s - avg(s) over (partition by city_key) as seasonal from phases)
select city_key, datetime, observed, trend, seasonal, observed - trend - seasonal as residual
from trended left join seasons using (city_key, phase)"""


# an even period over hours with many gaps
HOURLY_DECOMPOSED = f"""with placed as (
    select city_key, datetime, epoch(datetime)::bigint // 3600 as h, steps as observed from averaged),
trended as (
    select p.city_key, p.datetime, p.observed, p.h % 4 as phase, case when count(q.h) = 5 then
        sum(q.observed * case when abs(q.h - p.h) = 2 then 0.5 else 1 end) / 4 end as trend
    from placed p join placed q on p.city_key = q.city_key and q.h between p.h - 2 and p.h + 2 group by all),
phases as (select city_key, phase, avg(observed - trend) as s from trended where trend is not null group by all),
seasons as (select city_key, phase, s - avg(s) over (partition by city_key) as seasonal from phases)
select city_key, datetime, observed, trend, seasonal, observed - trend - seasonal as residual
from trended left join seasons using (city_key, phase)"""
SERIES_CTES = {"markets": MARKETS, "daily": DAILY_SERIES}


def _series(lags: int | None = None) -> dict[str, str]:
    found = SERIES_CTES | {"centred": CENTRED.format(v="no2", r="daily")}
    return found | ({"products": _products(lags)} if lags else {})


TESTED = ("no2", "pm10", "o3")
CATEGORIES = (("season", "is_weekend"), ("city", "season"), ("month", "day_of_week"))


def _moments_sql(group: str) -> str:
    return " union all ".join(
        f"""select '{m}' as measure, {group} as grp, count({m}) as n, avg({m}) as mean, var_pop({m}) * count({m}) as squares
        from study where {group} is not null and {m} is not null group by {group}""" for m in TESTED)


ANOVA_SQL = f"""select measure, (ssb / (k - 1)) / (ssw / (n - k)) as statistic, k - 1 as between, n - k as within,
    ssb / (ssb + ssw) as eta_squared, k as groups, n::bigint as n
from (select measure, count(*) as k, sum(n)::bigint as n, sum(squares) as ssw, sum(n * (mean - grand) ** 2) as ssb from (
    select *, sum(n * mean) over (partition by measure) / sum(n) over (partition by measure) as grand from ({_moments_sql('season')}))
    group by measure)"""


def _welch(a: str, b: str) -> str:
    ea, eb = (f"{s}.squares / ({s}.n - 1) / {s}.n" for s in (a, b))
    return (f"({a}.mean - {b}.mean) / sqrt({ea} + {eb}) as statistic, "
            f"({ea} + {eb}) ** 2 / (({ea}) ** 2 / ({a}.n - 1) + ({eb}) ** 2 / ({b}.n - 1)) as freedom")


T_SQL = f"""with m as ({_moments_sql('is_weekend')})
select a.measure, a.mean - b.mean as difference, {_welch('a', 'b')}, a.n as n_first, b.n as n_second
from m a join m b on a.measure = b.measure and a.grp = 0 and b.grp = 1"""
GROUP_TESTS_SQL = f"""with m as ({_moments_sql('season')})
select a.measure, 't' as test, a.grp as a, b.grp as b, {_welch('a', 'b')} from m a join m b on a.measure = b.measure and a.grp < b.grp
union all select measure, 'anova', null, null, statistic, within::double from ({ANOVA_SQL})"""
CHI_SQL = " union all ".join(
    f"""select '{a}' as a, '{b}' as b, sum((o - e) ** 2 / e) as statistic, any_value((nr - 1) * (nc - 1)) as freedom,
        sqrt(sum((o - e) ** 2 / e) / any_value(n) / any_value(least(nr, nc) - 1)) as cramers_v, any_value(n) as n
    from (select coalesce(o, 0) as o, r * c * 1.0 / n as e, n, nr, nc
        from (select {a} as va, count(*) as r from study group by 1) join (select {b} as vb, count(*) as c from study group by 1) on true
        join (select count(*) as n, count(distinct {a}) as nr, count(distinct {b}) as nc from study) on true
        left join (select {a} as va, {b} as vb, count(*) as o from study group by 1, 2) using (va, vb))""" for a, b in CATEGORIES)

# two steps ahead and more by the recursion of an autoregression of order 2 on first differences
AR_STEPS = 5
AR_SQL = f"""with recursive fits as (
    select city_key, (t0 * s11 - t1 * s01) / (s00 * s11 - s01 * s01) as b1, (t1 * s00 - t0 * s01) / (s00 * s11 - s01 * s01) as b2, my, m0, m1
    from (select city_key, covar_pop(p1, p1) as s00, covar_pop(p1, p2) as s01, covar_pop(p2, p2) as s11, covar_pop(p1, w) as t0,
        covar_pop(p2, w) as t1, avg(w) as my, avg(p1) as m0, avg(p2) as m1 from moved where p2 is not null group by city_key)),
ahead as (
    select city_key, 0 as step, datetime, no2 as forecast, w as r1, p1 as r2, b1, b2, my - b1 * m0 - b2 * m1 as b0
    from moved join fits using (city_key) qualify row_number() over (partition by city_key order by datetime desc) = 1
    union all
    select city_key, step + 1, datetime + interval 1 day, forecast + b0 + b1 * r1 + b2 * r2, b0 + b1 * r1 + b2 * r2, r1, b1, b2, b0
    from ahead where step < {AR_STEPS})
select city_key, step, datetime, forecast from ahead where step > 0"""
MOVED = """select *, lag(w) over (partition by city_key order by datetime) as p1, lag(w, 2) over (partition by city_key order by datetime) as p2
    from (select *, no2 - lag(no2) over (partition by city_key order by datetime) as w from daily)"""

# two predictors with squares and their product
CURVED = ("temperature", "traffic_index")
CURVES = [t for n in (1, 2) for t in combinations_with_replacement(CURVED, n)]
CURVE_ROWS = "select no2 as y, {} from study where {}".format(
    ", ".join(f"{' * '.join(t)} as t{i}" for i, t in enumerate(CURVES)), " and ".join(f"{c} is not null" for c in ("no2", *CURVED)))


def _least_squares(relation: str, y: str) -> str:
    """One row: b0 ..., the means m0 ..., the diagonal v0 ... of the inverse moments, r2, n and the response's variance."""
    size = len(CURVES)
    moments = [f"covar_pop(t{i}, t{j}) as s{i}{j}" for i in range(size) for j in range(i, size)]
    grid = [[_cell(i, j) for j in range(size)] for i in range(size)]
    solved = [f"{_det([[f'c{i}' if j == k else grid[i][j] for j in range(size)] for i in range(size)])} / {_det(grid)} as b{k}"
              for k in range(size)]
    inverse = [f"{_det([[c for j, c in enumerate(row) if j != k] for i, row in enumerate(grid) if i != k])} / {_det(grid)} as v{k}"
               for k in range(size)]
    explained = " + ".join(f"b{k} * c{k}" for k in range(size))
    return f"""select *, ({explained}) / yy as r2 from (select *, {', '.join(solved + inverse)} from (
        select count(*) as n, avg({y}) as my, var_pop({y}) as yy, {', '.join(moments)},
            {', '.join(f'covar_pop(t{i}, {y}) as c{i}, avg(t{i}) as m{i}' for i in range(size))} from {relation}))"""


CURVE_CTES = {"curves": CURVE_ROWS, "curve_fit": _least_squares("curves", "y"), "curve_errors": "select {}, (y - ({})) ** 2 as e from curves, curve_fit".format(
    ", ".join(f"t{i}" for i in range(len(CURVES))),
    "my + " + " + ".join(f"b{i} * (t{i} - m{i})" for i in range(len(CURVES)))), "error_fit": _least_squares("curve_errors", "e")}
_FREE = f"(n - {len(CURVES)} - 1)"
CURVE_SQL = " union all ".join(
    f"""select '{regression.term_name(t)}' as term, b{i} as coefficient, sqrt(yy * (1 - r2) / {_FREE} * v{i}) as std_error,
        b{i} / sqrt(yy * (1 - r2) / {_FREE} * v{i}) as statistic, v{i} * s{i}{i} as vif from curve_fit""" for i, t in enumerate(CURVES))
CURVE_SUMMARY_SQL = f"""select f.n, f.r2, 1 - (1 - f.r2) * (f.n - 1) / (f.n - {len(CURVES)} - 1) as adjusted_r2, sqrt(f.yy * (1 - f.r2)) as rmse,
    f.r2 / {len(CURVES)} / ((1 - f.r2) / (f.n - {len(CURVES)} - 1)) as f_statistic, f.n * e.r2 as bp_statistic, {len(CURVES)} as bp_freedom
from curve_fit f, error_fit e"""
NEAR_BY = ("humidity", "wind_speed", "pressure")
NEIGHBOURS_SQL = f"""with known as (select * from readings where {' and '.join(f'{c} is not null' for c in NEAR_BY)}),
spread as (select {', '.join(f'stddev_pop({c}) as s{i}' for i, c in enumerate(NEAR_BY))} from known where pm10 is not null),
asked as (select event_id, {', '.join(NEAR_BY)} from known where pm10 is null),
apart as (select a.event_id, b.pm10, {' + '.join(f'((a.{c} - b.{c}) / s{i}) ** 2' for i, c in enumerate(NEAR_BY))} as d
    from asked a, known b, spread where b.pm10 is not null),
ranked as (select event_id, pm10, rank() over (partition by event_id order by d) as r from apart),
means as (select event_id, avg(pm10) as m from ranked where r <= 5 group by event_id)
select event_id, coalesce(pm10, m) as pm10_filled from readings left join means using (event_id)"""
OUTLYING = ("temperature", "humidity", "no2", "pm25")
BOOSTED = ("temperature", "wind_speed", "precipitation", "pressure", "traffic_index", "month", "day_of_week")


ENTRIES: dict[str, Entry] = {
    "spearman_matrix": entry(
        lambda t: spearman.spearman_matrix(_steady(t)), _both_ways(_spearman_sql(HALF, "steady")), "study", doubles="rho",
        ctes={"steady": STEADY}),
    "spearman_with_gaps": entry(
        lambda t: spearman.spearman_matrix(_gaps(t), FLAT_COLUMNS), _both_ways(_spearman_sql(FLAT_HALF, "gapped")), "study",
        doubles="rho", ctes={"steady": STEADY, "gapped": FLAT}),
    "spearman_by_city": entry(
        lambda t: spearman.rank_correlations(_steady(t), RANKED_CITY, ["city"]), _spearman_sql(RANKED_CITY, "steady", "city"), "study",
        doubles="rho", ctes={"steady": STEADY}),
    "lagged_correlations": entry(
        lambda t: spearman.lagged_correlations(t.hourly, LAGGED_PREDICTORS, lags=LAGS), _lagged_sql(), "hourly", doubles="r"),
    "seasonal_correlations": entry(
        lambda t: spearman.seasonal_correlations(t.study, stats.TESTED_PAIRS), _seasonal_sql(), "study", doubles="r"),
    "autocorrelation": entry(
        lambda t: timeseries.autocorrelation(_daily(t), "no2", lags=ACF_LAGS), ACF_SQL, "shipments", doubles="acf pacf bound",
        ctes=_series(ACF_LAGS)),
    "autocorrelation_hourly": entry(
        lambda t: timeseries.autocorrelation(t.hourly, "pm10", lags=ACF_LAGS), ACF_SQL, "hourly", doubles="acf pacf bound",
        ctes={"centred": CENTRED.format(v="pm10", r="hourly"), "products": _products(ACF_LAGS)}),
    "decompose_weekly": entry(
        lambda t: timeseries.decompose(_markets(t), "no2", PERIOD, DAY_US), DECOMPOSED, "shipments",
        doubles="observed trend seasonal residual", ctes=SERIES_CTES),
    "decompose_hourly": entry(
        lambda t: timeseries.decompose(t.feed("readings"), "steps", 4), HOURLY_DECOMPOSED, "readings",
        doubles="observed trend seasonal residual",
        ctes={"averaged": "select city_key, datetime, avg(steps) as steps from readings where steps is not null group by 1, 2"}),
    "kpss_test": entry(
        lambda t: timeseries.kpss(_daily(t), "no2", lags=KPSS_LAGS), KPSS_SQL, "shipments", doubles="statistic long_run_variance",
        ctes=_series(KPSS_LAGS)),
    "adf_test": entry(
        lambda t: timeseries.adf(_daily(t), "no2", lags=2), _adf_sql(), "shipments", doubles="statistic coefficient critical_5",
        ctes=_series()),
    "anova": entry(
        lambda t: hypotheses.anova(t.study, TESTED, "season").drop("p_value"), ANOVA_SQL, "study", doubles="statistic eta_squared"),
    "t_tests": entry(
        lambda t: hypotheses.t_tests(t.study, TESTED, "is_weekend", 0, 1).drop("p_value"), T_SQL, "study",
        doubles="difference statistic freedom"),
    "group_tests": entry(
        lambda t: hypotheses.group_tests(t.study, TESTED, "season").drop("p_value"), GROUP_TESTS_SQL, "study", doubles="statistic freedom"),
    "chi_square_tests": entry(
        lambda t: hypotheses.chi_square_tests(t.study, CATEGORIES).drop("p_value"), CHI_SQL, "study", doubles="statistic cramers_v"),
    "arima_ar_forecast": entry(
        lambda t: arima.forecast(_daily(t), "no2", (2, 1, 0), AR_STEPS, DAY_US), AR_SQL, "shipments", doubles="forecast",
        ctes=SERIES_CTES | {"moved": MOVED}),
    "polynomial_regression": entry(
        lambda t: regression.polynomial_regression(t.study, "no2", CURVED)[0].filter("term <> 'const'").drop("p_value"), CURVE_SQL, "study",
        doubles="coefficient std_error statistic vif", ctes=CURVE_CTES),
    "regression_diagnostics": entry(
        lambda t: regression.polynomial_regression(t.study, "no2", CURVED)[1].drop("f_p_value", "bp_p_value"), CURVE_SUMMARY_SQL, "study",
        doubles="r2 adjusted_r2 rmse f_statistic bp_statistic", ctes=CURVE_CTES),
    "impute_by_neighbours": entry(
        lambda t: neighbours.impute_by_neighbours(t.feed("readings"), "pm10", NEAR_BY, 5).select("event_id", "pm10_filled"), NEIGHBOURS_SQL,
        "readings", doubles="pm10_filled"),
    # searches and trees that SQL does not express; tests/test_models.py holds them against straight versions
    "arima_fit": entry(lambda t: arima.arima(_daily(t), "no2", (1, 1, 1)), None),
    "arima_forecast": entry(lambda t: arima.forecast(_daily(t), "no2", (1, 1, 1), 14, DAY_US), None),
    "boosted_trees": entry(lambda t: boosting.boosted_folds(t.study, "no2", BOOSTED), None),
    "isolation_scores": entry(
        lambda t: outliers.isolation_scores(t.feed("readings"), OUTLYING, trees=50).select("event_id", "anomaly_score"), None),
    "density_clusters": entry(
        lambda t: clusters.density_clusters(t.feed("readings"), ("temperature", "no2"), 0.5, 8).select("event_id", "cluster", "cluster_role"), None),
}
