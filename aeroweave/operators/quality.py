"""Validation, data dictionary and quality reports as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.dims import UNIT_RANGES, dim_description
from aeroweave.dims.descriptions import NO_DESCRIPTION
from aeroweave.functions.calendar import hour_floor, seconds_between
from aeroweave.operators.aggregates import null_counts
from aeroweave.operators.schema import SEQ
from aeroweave.plans.chunks import TARGET_ROWS
from aeroweave.plans.quantiles import exact_quantiles, quantile_name
from aeroweave.plans.shift import Shift, shift_rows
from aeroweave.plans.small import attach_scalars, broadcast_if_small

IQR_FACTOR = 1.5
NUMBERS = ("double", "float", "int", "bigint", "smallint", "tinyint")

# Columns by category
COLUMN_GROUPS = {
    "identifiers": ("city_key", "city", "datetime", "date"),
    "geographic": ("lat", "lon"),
    "time": ("hour", "month", "day_of_week", "is_night", "is_weekday", "time_period", "season",
             "is_rush_hour", "is_weekend", "is_holiday"),
    "weather": ("temperature", "humidity", "precipitation", "wind_speed", "wind_direction", "pressure",
                "weather_code", "is_rainy", "temp_category"),
    "air_quality": ("no2", "pm10", "o3", "aqi_avg", "air_quality_level"),
    "traffic": ("current_speed", "free_flow_speed", "congestion_level", "traffic_index", "traffic_level",
                "holiday_name"),
}

# Limits in μg/m³ used when a caller names none
DEFAULT_LIMITS = {"no2": 200.0, "pm10": 50.0, "o3": 120.0}


def _numbers(df: DataFrame, cols=None) -> list[str]:
    return [c for c, kind in df.dtypes if kind in NUMBERS and (cols is None or c in cols)]


def validate_gold(df: DataFrame, expected_hours: int | None = None) -> DataFrame:
    """check, column, value: nulls and their percentage, time range, cities, rows per city and completeness.

    One aggregate per city over the table, and one over the few rows of cities.
    """
    cols = [c for c in df.columns if c != SEQ]
    per_city = df.groupBy(F.col("city_key").alias("_city")).agg(
        F.count("*").alias("_rows"), F.min("datetime").alias("_first"), F.max("datetime").alias("_last"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    span = (F.unix_micros(F.date_trunc("hour", F.max("_last"))) - F.unix_micros(F.date_trunc("hour", F.min("_first")))) / F.lit(3.6e9) + 1
    whole = per_city.agg(
        F.sum("_rows").alias("rows"), F.min("_first").alias("first"), F.max("_last").alias("last"), F.count("_city").alias("cities"),
        F.min("_rows").alias("least"), F.max("_rows").alias("most"), F.avg("_rows").alias("mean"),
        (F.lit(expected_hours) if expected_hours else span).cast("bigint").alias("hours"),
        *[F.sum(f"_null_{i}").alias(f"_null_{i}") for i in range(len(cols))])
    checks = [("nulls", c, F.col(f"_null_{i}").cast("double")) for i, c in enumerate(cols)]
    checks += [("null_pct", c, F.try_divide(F.col(f"_null_{i}"), F.col("rows")) * 100) for i, c in enumerate(cols)]
    checks += [
        ("datetime_min", None, F.col("first")), ("datetime_max", None, F.col("last")), ("cities", None, F.col("cities")),
        ("min_records", None, F.col("least")), ("max_records", None, F.col("most")), ("mean_records", None, F.col("mean")),
        ("expected_hours", None, F.col("hours")), ("completeness_pct", None, F.try_divide(F.col("mean"), F.col("hours")) * 100)]
    rows = F.array(*[
        F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column"), value.cast("string").alias("value"),
                 (F.col(f"_null_{cols.index(column)}") > 0 if column else F.lit(True)).alias("_shown"))
        for check, column, value in checks])
    return whole.select(F.explode(rows).alias("_c")).select("_c.*").filter("_shown").drop("_shown")


def _with_known(df: DataFrame, rows: list[tuple], names: tuple[str, ...], column: str) -> DataFrame:
    """A fixed list of rows about columns, with the number of known values of each column."""
    counted = df.agg(*[F.count(c).alias(c) for c in dict.fromkeys(r[names.index(column)] for r in rows)])
    listed = F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)], F.col(r[names.index(column)]).alias("known"))
        for r in rows
    ])
    return counted.select(F.explode(listed).alias("_r")).select("_r.*")


def column_groups(df: DataFrame) -> DataFrame:
    """category, column, known for the columns the table has."""
    rows = [(g, c) for g, cols in COLUMN_GROUPS.items() for c in cols if c in df.columns]
    return _with_known(df, rows, ("category", "column"), "column")


def describe_columns(columns: DataFrame, descriptions: DataFrame | None = None) -> DataFrame:
    """Add ``description`` to a table with a ``column`` name column."""
    known = descriptions if descriptions is not None else dim_description(columns.sparkSession)
    named = broadcast_if_small(known.select(F.col("column_name").alias("column"), "description"))
    return columns.join(named, "column", "left").withColumn(
        "description", F.coalesce("description", F.lit(NO_DESCRIPTION))
    )


def data_dictionary(df: DataFrame, descriptions: DataFrame | None = None, approximate: bool = False) -> DataFrame:
    """column, description, data_type, nulls, null_pct, lowest, highest, mean, distinct_values.

    Numbers and flags get lowest, highest and mean; other columns the distinct count, which ``approximate`` makes a
    sketch of fixed size instead of a shuffle of each column's values.
    """
    kinds = dict(df.dtypes)
    measured = [c for c in df.columns if kinds[c] in NUMBERS or kinds[c] == "boolean"]
    named = [c for c in df.columns if c not in measured]

    def number(c: str) -> Column:
        return F.col(c).cast("int").cast("double") if kinds[c] == "boolean" else F.col(c).cast("double")

    summary = df.agg(
        F.count("*").alias("_rows"),
        *[F.count(c).alias(f"k_{c}") for c in df.columns],
        *[f(number(c)).alias(f"{tag}_{c}") for c in measured for tag, f in (("lo", F.min), ("hi", F.max), ("av", F.avg))],
    )
    if named:
        distinct = df.select(*named).agg(*[(F.approx_count_distinct if approximate else F.count_distinct)(c).alias(f"d_{c}") for c in named])
        summary = attach_scalars(summary, distinct)

    none = F.lit(None)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("data_type"),
            (F.col("_rows") - F.col(f"k_{c}")).alias("nulls"),
            (F.col(f"lo_{c}") if c in measured else none.cast("double")).alias("lowest"),
            (F.col(f"hi_{c}") if c in measured else none.cast("double")).alias("highest"),
            (F.col(f"av_{c}") if c in measured else none.cast("double")).alias("mean"),
            (none.cast("bigint") if c in measured else F.col(f"d_{c}")).alias("distinct_values"),
        )
        for c in df.columns
    ])
    long = summary.select("_rows", F.explode(rows).alias("_c")).select("_rows", "_c.*")
    share = F.round(F.try_divide(F.col("nulls"), F.col("_rows")) * 100, 2)
    return describe_columns(long.withColumn("null_pct", share).drop("_rows"), descriptions)


def units_reference(df: DataFrame) -> DataFrame:
    """measure, unit, lo, hi, known for the measures the table has."""
    rows = [r for r in UNIT_RANGES if r[0] in df.columns]
    return _with_known(df, rows, ("measure", "unit", "lo", "hi"), "measure")


def range_validation(df: DataFrame, ranges=UNIT_RANGES, by=()) -> DataFrame:
    """measure, unit, known, outside, outside_pct against the expected ranges, in one pass."""
    by = list(by)
    checked = [r for r in ranges if r[0] in df.columns]
    aggs = []
    for measure, _, lo, hi in checked:
        out = (F.col(measure) < lo) | (F.col(measure) > hi)
        aggs.append(F.struct(F.count(measure).alias("known"), F.count_if(out).alias("outside")).alias(measure))
    counted = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.lit(unit).alias("unit"), F.col(f"{m}.known"), F.col(f"{m}.outside"))
        for m, unit, *_ in checked
    ])
    long = counted.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")
    return long.withColumn("outside_pct", F.try_divide(F.col("outside"), F.col("known")) * 100)


def unit_verification(df: DataFrame) -> DataFrame:
    """measure, unit, lowest, highest, unit_ok: whether the extremes fit the expected range."""
    checked = [r for r in UNIT_RANGES if r[0] in df.columns]
    ends = [F.struct(F.min(m).cast("double").alias("lowest"), F.max(m).cast("double").alias("highest")).alias(m)
            for m, *_ in checked]
    rows = F.array(*[
        F.struct(
            F.lit(m).alias("measure"), F.lit(unit).alias("unit"), F.col(f"{m}.lowest"), F.col(f"{m}.highest"),
            ((F.col(f"{m}.lowest") >= lo) & (F.col(f"{m}.highest") <= hi)).alias("unit_ok"),
        )
        for m, unit, lo, hi in checked
    ])
    return df.agg(*ends).select(F.explode(rows).alias("_r")).select("_r.*")


def summary_statistics(df: DataFrame, cols=None, by=()) -> DataFrame:
    """measure, count, mean, std, min, q25, q50, q75, max per group."""
    by = list(by)
    cols = [c for c in _numbers(df, cols) if c not in by]
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs.append(F.struct(
            F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"),
        ).alias(c))
    moments = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by)
    both = moments.join(quartiles, by) if by else attach_scalars(moments, quartiles)
    rows = F.array(*[
        F.struct(
            F.lit(c).alias("measure"), F.col(c)["count"].alias("count"), F.col(c)["mean"].alias("mean"),
            F.col(c)["std"].alias("std"), F.col(c)["min"].alias("min"),
            *[F.col(quantile_name(c, p)).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)],
            F.col(c)["max"].alias("max"),
        )
        for c in cols
    ])
    return both.select(*by, F.explode(rows).alias("_m")).select(*by, "_m.*")


def missing_report(df: DataFrame, cols=None, by=("city_key", "month")) -> DataFrame:
    """Nulls and share of nulls per column and group."""
    if "month" in by and "month" not in df.columns:
        df = df.withColumn("month", F.month("datetime"))
    return null_counts(df, cols, by)


def temporal_gaps(df: DataFrame, keys=("city_key",), target_rows: int = TARGET_ROWS) -> DataFrame:
    """gap_start, gap_end, missing_hours of every run of hours without a row."""
    hours = df.select(*keys, hour_floor(F.col("datetime")).alias("datetime")).distinct()
    shifted = shift_rows(hours, [Shift("datetime", 1, "_prev")], keys, ("datetime",), target_rows)
    step = F.make_dt_interval(hours=F.lit(1))
    missing = (seconds_between(F.col("datetime"), F.col("_prev")) / F.lit(3600.0) - 1).cast("bigint")
    return shifted.withColumn("missing_hours", missing).filter(F.col("missing_hours") > 0).select(
        *keys, (F.col("_prev") + step).alias("gap_start"), (F.col("datetime") - step).alias("gap_end"), "missing_hours"
    )


def _fences(df: DataFrame, cols, by) -> tuple[DataFrame, dict[str, tuple[Column, Column]]]:
    quartiles = exact_quantiles(df, cols, [0.25, 0.75], by)
    if by:
        fenced = df.join(broadcast_if_small(quartiles, counted=df.select(*by).distinct()), by, "left")
    else:
        fenced = attach_scalars(df, quartiles)
    fences = {}
    for c in cols:
        q1, q3 = F.col(quantile_name(c, 0.25)), F.col(quantile_name(c, 0.75))
        fences[c] = (q1 - IQR_FACTOR * (q3 - q1), q3 + IQR_FACTOR * (q3 - q1))
    return fenced, fences


def flag_iqr_outliers(df: DataFrame, cols, by=()) -> DataFrame:
    """``{column}_outlier``: strictly beyond 1.5 interquartile ranges from the quartiles."""
    fenced, fences = _fences(df, list(cols), list(by))
    flags = {
        f"{c}_outlier": F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False)) for c, (lo, hi) in fences.items()
    }
    return fenced.withColumns(flags).select(*df.columns, *flags)


def remove_iqr_outliers(df: DataFrame, cols, by=()) -> DataFrame:
    """Rows without an outlier in any listed column."""
    flagged = flag_iqr_outliers(df, cols, by)
    clean = reduce(lambda a, b: a & b, [~F.col(f"{c}_outlier") for c in cols])
    return flagged.filter(clean).select(*df.columns)


def iqr_outliers(df: DataFrame, cols, by=()) -> DataFrame:
    """measure, q25, q75, lower, upper, outliers per group."""
    cols, by = list(cols), list(by)
    fenced, fences = _fences(df, cols, by)
    aggs = []
    for c, (lo, hi) in fences.items():
        out = (F.col(c) < lo) | (F.col(c) > hi)
        aggs.append(F.struct(
            F.max(quantile_name(c, 0.25)).alias("q25"), F.max(quantile_name(c, 0.75)).alias("q75"),
            F.max(lo).alias("lower"), F.max(hi).alias("upper"), F.count_if(out).alias("outliers"),
        ).alias(f"_o_{c}"))
    counted = fenced.groupBy(*by).agg(*aggs) if by else fenced.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"_o_{c}").alias("o")) for c in cols])
    return counted.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.measure", "_r.o.*")


def exceedance_flags(df: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """``{column}_exceeds``: 1 above the limit, else 0."""
    limits = {c: v for c, v in (limits or DEFAULT_LIMITS).items() if c in df.columns}
    return df.withColumns({f"{c}_exceeds": F.when(F.col(c) > v, 1).otherwise(0) for c, v in limits.items()})
