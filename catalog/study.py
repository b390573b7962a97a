"""Profiles, correlation study and quality reports."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import functions as F

from aeroweave.dims import DESCRIPTIONS, UNIT_RANGES
from aeroweave.dims.descriptions import NO_DESCRIPTION
from aeroweave.operators import aggregates, quality, stats
from catalog.entry import Entry, entry

STUDY = stats.STUDY_COLUMNS


def _r(x: str, y: str) -> str:
    """Pearson r over complete pairs, null where a side is constant."""
    fx = f"case when {y} is not null then {x} end"
    fy = f"case when {x} is not null then {y} end"
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({fx}) * stddev_pop({fy}), 0)"


def _n(x: str, y: str) -> str:
    return f"count(case when {x} is not null and {y} is not null then 1 end)"


def _pairs_sql(pairs, relation: str = "study", by: str = "") -> str:
    head, tail = (f"{by}, ", f" group by {by}") if by else ("", "")
    return " union all ".join(
        f"select {head}'{x}' as x, '{y}' as y, {_r(x, y)} as r, {_n(x, y)} as n from {relation}{tail}" for x, y in pairs
    )


MATRIX_SQL = _pairs_sql([(x, y) for x in STUDY for y in STUDY])
FOCUSED = [(x, y) for x in stats.POLLUTANTS for y in STUDY if y not in stats.POLLUTANTS]
CITY_PAIRS = [(x, y) for x in stats.POLLUTANTS for y in stats.CITY_COLUMNS if y not in stats.POLLUTANTS]
TOP_PAIRS = [(x, y) for x in stats.POLLUTANTS for y in STUDY if y != x]

# Two-sided p-value of t with whole degrees of freedom v, by the finite trigonometric series
def _tests_sql(pairs) -> str:
    return """select upper(y) as pollutant, x as predictor, r as correlation, n, p as p_value,
    case when p < 0.001 then '***' when p < 0.01 then '**' when p < 0.05 then '*' else '' end as significance
from (
    select x, y, r, n, 1 - case when v % 2 = 0 then abs(r) * even_sum
        else 2 / pi() * (asin(abs(r)) + abs(r) * odd_sum) end as p
    from (
        select x, y, r, n, v,
            (select sum(exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1.0) + k * ln(1 - r * r)))
                from range(0, v // 2) s(k)) as even_sum,
            coalesce((select sum(exp(lgamma(0.5) - ln(2.0) + lgamma(k + 1.0) - lgamma(k + 1.5)
                    + (k + 0.5) * ln(1 - r * r)))
                from range(0, (v - 1) // 2) s(k)), 0) as odd_sum
        from (select *, n - 2 as v from (""" + _pairs_sql(pairs) + """) where n > 2)))"""


TESTS_SQL, SCATTER_TESTS_SQL = _tests_sql(stats.TESTED_PAIRS), _tests_sql(stats.SCATTER_PAIRS)

TERMS = stats.REGRESSION_PREDICTORS


def _det(rows) -> str:
    """Determinant written out over permutations."""
    size = len(rows)
    parts = []
    for order in permutations(range(size)):
        swaps = sum(1 for i, j in combinations(range(size), 2) if order[i] > order[j])
        product = " * ".join(rows[i][j] for i, j in enumerate(order))
        parts.append(f"{'-' if swaps % 2 else '+'} {product}")
    return "(" + " ".join(parts) + ")"


def _cell(i: int, j: int) -> str:
    return f"s{min(i, j)}{max(i, j)}"


def _regression_sql() -> str:
    """Normal equations of the centred moments solved by Cramer's rule."""
    size = len(TERMS)
    moments = [f"covar_pop({TERMS[i]}, {TERMS[j]}) as s{i}{j}" for i in range(size) for j in range(i, size)]
    fits = []
    for y in stats.POLLUTANTS:
        crossed = [f"covar_pop({x}, {y}) as t{i}" for i, x in enumerate(TERMS)]
        means = [f"avg({x}) as m{i}" for i, x in enumerate(TERMS)]
        known = " and ".join(f"{c} is not null" for c in (*TERMS, y))
        fits.append(f"""select '{y}' as pollutant, count(*) as n, avg({y}) as my, var_pop({y}) as syy,
            {', '.join([*moments, *crossed, *means])} from study where {known}""")
    grid = [[_cell(i, j) for j in range(size)] for i in range(size)]
    solved = []
    for k in range(size):
        replaced = [[f"t{i}" if j == k else grid[i][j] for j in range(size)] for i in range(size)]
        solved.append(f"{_det(replaced)} / {_det(grid)} as b{k}")
    weighted = " + ".join(f"b{k} * t{k}" for k in range(size))
    shifted = " - ".join(f"b{k} * m{k}" for k in range(size))
    terms = " union all ".join(
        [f"select pollutant, '{x}' as term, b{k} as coefficient, r2, n from solved" for k, x in enumerate(TERMS)]
        + ["select pollutant, 'intercept', my - " + shifted + ", r2, n from solved"]
    )
    return f"""with solved as (select *, ({weighted}) / syy as r2 from (
        select *, {', '.join(solved)} from ({' union all '.join(fits)}))) {terms}"""


SUMMARY_SQL = """select 'records' as item, cast(count(*) as varchar) as value from study
    union all select 'cities', cast(count(distinct city) as varchar) from study
    union all select 'date_min', cast(min(date) as varchar) from study
    union all select 'date_max', cast(max(date) as varchar) from study
    union all select distinct 'city', city from study"""

SCATTER_SQL = " union all ".join(
    f"select '{x}' as predictor, '{y}' as pollutant, {x} as x, {y} as y from study where {x} is not null and {y} is not null"
    for x, y in stats.SCATTER_PAIRS
)

READING_COLUMNS = ("temperature", "humidity", "wind_speed", "pressure", "no2", "pm10", "pm25", "o3", "traffic_index")
SUMMARY_COLUMNS = READING_COLUMNS


def _statistics_sql(by: str = "") -> str:
    head, tail = (f"{by}, ", f" group by {by}") if by else ("", "")
    return " union all ".join(
        f"""select {head}'{c}' as measure, count({c}) as count, avg({c}) as mean, stddev_samp({c}) as std, min({c}) as min,
            quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, quantile_cont({c}, 0.75) as q75,
            max({c}) as max from readings{tail}""" for c in SUMMARY_COLUMNS)


def _iqr_sql(by: str = "") -> str:
    head, tail, on = (f"{by}, ", f" group by {by}", f"using ({by})") if by else ("", "", "on true")
    parts = []
    for c in SUMMARY_COLUMNS:
        parts.append(f"""select {head}'{c}' as measure, any_value(q25) as q25, any_value(q75) as q75,
            any_value(q25 - 1.5 * (q75 - q25)) as lower, any_value(q75 + 1.5 * (q75 - q25)) as upper,
            count(case when {c} < q25 - 1.5 * (q75 - q25) or {c} > q75 + 1.5 * (q75 - q25) then 1 end) as outliers
        from readings join (select {head}quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.75) as q75
            from readings{tail}) {on}{tail}""")
    return " union all ".join(parts)


def _null_sql(columns, by: str = "", relation: str = "readings") -> str:
    head, tail = (f"{by}, ", f" group by {by}") if by else ("", "")
    return " union all ".join(
        f"""select {head}'{c}' as column, count(*) - count({c}) as nulls,
            100.0 * (count(*) - count({c})) / count(*) as null_pct from {relation}{tail}""" for c in columns)


CHECKED_UNITS = [r for r in UNIT_RANGES if r[0] in READING_COLUMNS]
RANGE_SQL = " union all ".join(
    f"""select '{m}' as measure, '{u}' as unit, count({m}) as known,
        count(case when {m} < {lo} or {m} > {hi} then 1 end) as outside,
        100.0 * count(case when {m} < {lo} or {m} > {hi} then 1 end) / count({m}) as outside_pct from readings"""
    for m, u, lo, hi in CHECKED_UNITS)
UNIT_SQL = " union all ".join(
    f"""select '{m}' as measure, '{u}' as unit, min({m}) as lowest, max({m}) as highest,
        min({m}) >= {lo} and max({m}) <= {hi} as unit_ok from readings""" for m, u, lo, hi in CHECKED_UNITS)
UNITS_SQL = " union all ".join(
    f"select '{m}' as measure, '{u}' as unit, {lo}::double as lo, {hi}::double as hi, count({m}) as known from readings"
    for m, u, lo, hi in CHECKED_UNITS)

GOLD_COLUMNS = (
    "city_key", "datetime", "temperature", "humidity", "precipitation", "wind_speed", "wind_direction", "pressure",
    "date", "hour", "month", "day_of_week", "is_night", "is_weekday", "no2", "pm10", "o3", "aqi_avg", "current_speed",
    "free_flow_speed", "congestion_level", "traffic_index", "is_holiday", "holiday_name", "time_period", "season",
    "city", "lat", "lon", "weather_code", "is_rush_hour", "is_weekend",
    "is_rainy", "temp_category", "air_quality_level", "traffic_level",
)
GROUPS_SQL = " union all ".join(
    f"select '{g}' as category, '{c}' as column, count({c}) as known from gold"
    for g, cols in quality.COLUMN_GROUPS.items() for c in cols if c in GOLD_COLUMNS)

VALIDATE_SQL = " union all ".join(
    [f"""select '{check}' as check, '{c}' as column, {value} as value, null::varchar as instant from gold
        having count(*) > count({c})""" for c in GOLD_COLUMNS
     for check, value in (("nulls", f"(count(*) - count({c}))::double"), ("null_pct", f"100.0::double * (count(*) - count({c})) / count(*)"))]
    + ["select 'cities', null, count(distinct city_key), null from gold",
       "select 'datetime_min', null, null, cast(min(datetime) as varchar) from gold",
       "select 'datetime_max', null, null, cast(max(datetime) as varchar) from gold",
       "select 'min_records', null, min(n), null from (select count(*) as n from gold group by city_key)",
       "select 'max_records', null, max(n), null from (select count(*) as n from gold group by city_key)",
       "select 'mean_records', null, avg(n), null from (select count(*) as n from gold group by city_key)",
       "select 'expected_hours', null, 720, null",
       "select 'completeness_pct', null, 100 * avg(n) / 720, null from (select count(*) as n from gold group by city_key)"])

DICTIONARY_KINDS = {"event_id": "bigint", "city_key": "string", "ts": "timestamp_ntz", "temperature": "double",
                    "no2": "double", "wet": "boolean"}
DICTIONARY_SOURCE = {"described": "select event_id, city_key, ts, temperature, no2, precipitation > 0.5 as wet from readings"}


def _dictionary_sql() -> str:
    parts = []
    for c, kind in DICTIONARY_KINDS.items():
        text = DESCRIPTIONS.get(c, NO_DESCRIPTION)
        if kind in ("string", "timestamp_ntz"):
            numbers = f"null::double as lowest, null::double as highest, null::double as mean, count(distinct {c}) as distinct_values"
        else:
            value = f"cast({c} as integer)" if kind == "boolean" else c
            numbers = f"""cast(min({value}) as double) as lowest, cast(max({value}) as double) as highest,
                avg({value}) as mean, null::bigint as distinct_values"""
        parts.append(f"""select '{c}' as column, '{kind}' as data_type, count(*) - count({c}) as nulls, {numbers},
            round(100.0 * (count(*) - count({c})) / count(*), 2) as null_pct, '{text}' as description from described""")
    return " union all ".join(parts)


def _dictionary(t):
    rows = t.feed("readings").select("event_id", "city_key", "ts", "temperature", "no2", (F.col("precipitation") > 0.5).alias("wet"))
    return quality.data_dictionary(rows)


def _validate(t):
    checks = quality.validate_gold(t.gold, expected_hours=720)
    return checks.select("check", "column", F.col("value").try_cast("double").alias("value"),
                         F.when(F.col("check").startswith("datetime"), F.col("value")).alias("instant"))


def _profile(columns, by: str) -> str:
    return f"select {by}, {', '.join(f'avg({c}) as {c}' for c in columns)} from study group by {by}"


ENTRIES: dict[str, Entry] = {
    "monthly_profile": entry(
        lambda t: aggregates.monthly_profile(t.study),
        _profile(("no2", "pm10", "o3", "temperature", "traffic_index"), "month"), "study",
        doubles="no2 pm10 o3 temperature traffic_index"),
    "weekend_profile": entry(
        lambda t: aggregates.weekend_profile(t.study),
        """select case when is_weekend = 0 then 'Weekday' else 'Weekend' end as day_type, avg(no2) as no2,
            avg(pm10) as pm10, avg(traffic_index) as traffic_index from study group by 1""", "study",
        doubles="no2 pm10 traffic_index"),
    "season_profile": entry(
        lambda t: aggregates.season_profile(t.study), _profile(("no2", "pm10", "o3", "temperature"), "season"), "study",
        doubles="no2 pm10 o3 temperature"),
    "records_per_city": entry(
        lambda t: aggregates.records_per_city(t.gold),
        """select min(n) as min_records, max(n) as max_records, avg(n) as mean_records
        from (select count(*) as n from gold group by city_key)""", "gold", doubles="mean_records"),
    "completeness_pct": entry(
        lambda t: aggregates.completeness(t.gold),
        """select avg(n) as mean_records,
            cast((epoch(max(hi)) - epoch(min(lo))) / 3600 + 1 as bigint) as expected_hours,
            100 * avg(n) / ((epoch(max(hi)) - epoch(min(lo))) / 3600 + 1) as completeness_pct
        from (select count(*) as n, min(datetime) as lo, max(datetime) as hi from gold group by city_key)""",
        "gold", doubles="mean_records completeness_pct"),
    "null_counts": entry(
        lambda t: aggregates.null_counts(t.feed("readings"), READING_COLUMNS), _null_sql(READING_COLUMNS), "readings",
        doubles="null_pct"),
    "distinct_cities": entry(
        lambda t: aggregates.distinct_cities(t.gold), "select count(distinct city_key) as cities from gold", "gold"),
    "date_range": entry(
        lambda t: aggregates.date_range(t.gold), "select min(datetime) as first, max(datetime) as last from gold", "gold"),
    "source_counts": entry(
        lambda t: aggregates.source_counts(t.feed("bronze_traffic")),
        "select data_source, count(*) as rows from bronze_traffic group by data_source", "bronze_traffic"),
    "city_ranking": entry(
        lambda t: aggregates.city_ranking(t.gold),
        " union all ".join(
            f"""select city_key, '{c}' as pollutant, avg({c}) as mean_level,
                cast(rank() over (order by avg({c}) desc) as integer) as rank from gold group by city_key"""
            for c in ("no2", "pm10", "o3")), "gold", doubles="mean_level"),
    "correlation_matrix": entry(lambda t: stats.correlation_matrix(t.study), MATRIX_SQL, "study", doubles="r"),
    "pollutant_correlations": entry(
        lambda t: stats.pollutant_correlations(stats.pollutant_pairs(t.study)), _pairs_sql(FOCUSED), "study", doubles="r"),
    "city_correlations": entry(
        lambda t: stats.city_correlations(t.study), _pairs_sql(CITY_PAIRS, by="city"), "study", doubles="r"),
    "top_correlations": entry(
        lambda t: stats.top_correlations(stats.pollutant_pairs(t.study)),
        f"""select x as pollutant, y as variable, r,
            cast(row_number() over (partition by x order by round(abs(r), 12) desc, y) as integer) as rank
        from ({_pairs_sql(TOP_PAIRS)}) where r is not null""", "study", doubles="r"),
    "scatter_tests": entry(
        lambda t: stats.scatter_tests(t.study), SCATTER_TESTS_SQL, "study", doubles="correlation p_value"),
    "scatter_points": entry(lambda t: stats.scatter_points(t.study), SCATTER_SQL, "study", doubles="x y"),
    "pearson_tests": entry(
        lambda t: stats.pearson_tests(t.study), TESTS_SQL, "study", doubles="correlation p_value"),
    "pollutant_regression": entry(
        lambda t: stats.pollutant_regression(t.study), _regression_sql(), "study", doubles="coefficient r2"),
    "study_summary": entry(lambda t: stats.study_summary(t.study), SUMMARY_SQL, "study"),
    "validate_gold": entry(_validate, VALIDATE_SQL, "gold", doubles="value"),
    "column_groups": entry(lambda t: quality.column_groups(t.gold), GROUPS_SQL, "gold"),
    "data_dictionary": entry(_dictionary, _dictionary_sql(), "readings", doubles="lowest highest mean null_pct",
                             ctes=DICTIONARY_SOURCE),
    "describe_join": entry(
        lambda t: quality.describe_columns(aggregates.null_counts(t.feed("readings"), ["no2", "steps"]).select("column", "nulls")),
        f"""select 'no2' as column, count(*) - count(no2) as nulls, '{DESCRIPTIONS['no2']}' as description from readings
        union all select 'steps', count(*) - count(steps), '{NO_DESCRIPTION}' from readings""", "readings"),
    "units_reference": entry(
        lambda t: quality.units_reference(t.feed("readings").select(*READING_COLUMNS)), UNITS_SQL, "readings"),
    "range_validation": entry(
        lambda t: quality.range_validation(t.feed("readings").select(*READING_COLUMNS)), RANGE_SQL, "readings",
        doubles="outside_pct"),
    "unit_verification": entry(
        lambda t: quality.unit_verification(t.feed("readings").select(*READING_COLUMNS)), UNIT_SQL, "readings",
        doubles="lowest highest"),
    "summary_statistics": entry(
        lambda t: quality.summary_statistics(t.feed("readings"), SUMMARY_COLUMNS), _statistics_sql(), "readings",
        doubles="mean std min q25 q50 q75 max"),
    "summary_statistics_by_city": entry(
        lambda t: quality.summary_statistics(t.feed("readings"), SUMMARY_COLUMNS, ["city_key"]),
        _statistics_sql("city_key"), "readings", doubles="mean std min q25 q50 q75 max"),
    "missing_report": entry(
        lambda t: quality.missing_report(t.hourly, ["pm10", "no2"]),
        " union all ".join(
            f"""select city_key, cast(month(datetime) as integer) as month, '{c}' as column, count(*) - count({c}) as nulls,
                100.0 * (count(*) - count({c})) / count(*) as null_pct from hourly group by 1, 2"""
            for c in ("pm10", "no2")), "hourly", doubles="null_pct"),
    "iqr_outliers": entry(
        lambda t: quality.iqr_outliers(t.feed("readings"), SUMMARY_COLUMNS), _iqr_sql(), "readings",
        doubles="q25 q75 lower upper"),
    "iqr_outliers_by_city": entry(
        lambda t: quality.iqr_outliers(t.feed("readings"), SUMMARY_COLUMNS, ["city_key"]), _iqr_sql("city_key"), "readings",
        doubles="q25 q75 lower upper"),
    "iqr_removal": entry(
        lambda t: quality.remove_iqr_outliers(t.feed("readings"), ["no2"]).select("event_id", "no2"),
        """select event_id, no2 from readings, (select quantile_cont(no2, 0.25) as a, quantile_cont(no2, 0.75) as b
            from readings) where no2 is null or not (no2 < a - 1.5 * (b - a) or no2 > b + 1.5 * (b - a))""",
        "readings", doubles="no2"),
}
