"""Regular hour and day grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.calendar import day_floor, hour_floor
from aeroweave.operators.schema import SEQ, ensure_datetime

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def _step(days: int = 0, hours: int = 0) -> Column:
    return F.make_dt_interval(F.lit(days), F.lit(hours))


def date_spine(spans: DataFrame, start: str = "start", end: str = "end", name: str = "date") -> DataFrame:
    """Every day from ``start`` to ``end``, both included, for each row of ``spans``."""
    days = F.explode(F.sequence(F.to_date(start), F.to_date(end), _step(days=1)))
    return spans.select(*[c for c in spans.columns if c not in (start, end)], days.alias(name))


def hour_spine(spans: DataFrame, start: str = "start", end: str = "end", name: str = "datetime") -> DataFrame:
    """Every hour from ``start`` to ``end``, both included.

    An end given as a bare date means its midnight, so the last day adds a single hour.
    Days are laid out first and hours within each day second, so no row ever holds a long
    list.
    """
    first, last = F.col(start).cast("timestamp_ntz"), F.col(end).cast("timestamp_ntz")
    keep = [c for c in spans.columns if c not in (start, end)]
    days = spans.select(
        *keep, hour_floor(first).alias("_first"), last.alias("_last"),
        F.explode(F.sequence(day_floor(first), day_floor(last), _step(days=1))).alias("_day"),
    )
    hours = days.select(
        *keep, "_first", "_last",
        F.explode(F.sequence(F.col("_day"), F.col("_day") + _step(hours=23), _step(hours=1))).alias(name),
    )
    return hours.filter((F.col(name) >= F.col("_first")) & (F.col(name) <= F.col("_last"))).drop("_first", "_last")


def _spans(df: DataFrame, keys, column: str) -> DataFrame:
    ends = [F.min(column).alias("start"), F.max(column).alias("end")]
    return df.groupBy(*keys).agg(*ends) if keys else df.agg(*ends)


def _first_known(column: str, position: Column) -> Column:
    return F.min_by(column, F.when(F.col(column).isNotNull(), position))


def _place(df: DataFrame, seq: str) -> Column:
    """Source order; of a table without one, such as a cleaned feed with one row per instant, the time."""
    return F.col(seq if seq in df.columns else "datetime")


def to_hourly(df: DataFrame, keys=("city_key",), seq: str = SEQ) -> DataFrame:
    """One row per hour from the first to the last of each key.

    Several rows in an hour give the first known value of each column; an hour without
    rows stays as a gap, and a gap of one hour takes the values of the hour before.
    ``keys=()`` lays one grid over the whole table.
    """
    keys = list(keys)
    rows = ensure_datetime(df)
    place = _place(df, seq)
    values = [c for c in df.columns if c not in (*keys, "datetime", "date", seq)]
    hour = hour_floor(F.col("datetime"))
    # every row goes to its own hour and, in case that is missing something, to the next
    sent = rows.withColumn("_later", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "_hour", F.when(F.col("_later") == 0, hour).otherwise(hour + _step(hours=1)))
    rank = F.struct("_later", place)
    hours = sent.groupBy(*keys, F.col("_hour").alias("datetime")).agg(*[_first_known(c, rank).alias(c) for c in values])
    grid = hour_spine(_spans(rows.select(*keys, hour.alias("datetime")), keys, "datetime"))
    on = [*keys, "datetime"]
    return grid.join(hours, on, "left").select(*on, *values, F.to_date("datetime").alias("date"))


def to_daily(df: DataFrame, keys=("city_key",), seq: str = SEQ) -> DataFrame:
    """One row per day: max, min or mean of numbers by column name, first known of the rest.

    Days without rows stay as gaps.
    """
    keys = list(keys)
    rows = ensure_datetime(df)
    kinds = dict(rows.dtypes)
    aggs = []
    for c in df.columns:
        if c in (*keys, "datetime", "date", seq):
            continue
        if not kinds[c].startswith(NUMERIC):
            aggs.append(_first_known(c, _place(df, seq)).alias(c))
        elif "max" in c.lower():
            aggs.append(F.max(c).alias(c))
        elif "min" in c.lower():
            aggs.append(F.min(c).alias(c))
        else:
            aggs.append(F.avg(c).alias(c))
    days = rows.groupBy(*keys, F.to_date("datetime").alias("date")).agg(*aggs)
    grid = date_spine(_spans(days, keys, "date"))
    joined = grid.join(days, [*keys, "date"], "left")
    return joined.withColumn("datetime", F.col("date").cast("timestamp_ntz"))
