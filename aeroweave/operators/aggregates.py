"""Profiles and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.operators.schema import SEQ


def _means(df: DataFrame, by, cols) -> DataFrame:
    return df.groupBy(*by).agg(*[F.avg(c).alias(c) for c in cols if c in df.columns])


def monthly_profile(df: DataFrame) -> DataFrame:
    return _means(df, ["month"], ["no2", "pm10", "o3", "temperature", "traffic_index"])


def weekend_profile(df: DataFrame) -> DataFrame:
    """Means per day type, labelled ``Weekday`` and ``Weekend``."""
    label = F.when(F.col("is_weekend").cast("int") == 0, "Weekday").otherwise("Weekend")
    return _means(df.withColumn("day_type", label), ["day_type"], ["no2", "pm10", "traffic_index"])


def season_profile(df: DataFrame) -> DataFrame:
    return _means(df, ["season"], ["no2", "pm10", "o3", "temperature"])


def _city_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("city_key").agg(F.count("*").alias("_rows"))


def records_per_city(df: DataFrame) -> DataFrame:
    """Smallest, largest and mean number of rows of a city."""
    return _city_sizes(df).agg(
        F.min("_rows").alias("min_records"), F.max("_rows").alias("max_records"), F.avg("_rows").alias("mean_records")
    )


def completeness(df: DataFrame, expected_hours: int | None = None) -> DataFrame:
    """Mean rows per city against the hours expected, in percent.

    Without ``expected_hours`` the span from the first to the last hour of the table is
    expected of every city.
    """
    sizes = df.groupBy("city_key").agg(
        F.count("*").alias("_rows"), F.min("datetime").alias("_first"), F.max("datetime").alias("_last")
    )
    span = (
        F.unix_micros(F.date_trunc("hour", F.max("_last"))) - F.unix_micros(F.date_trunc("hour", F.min("_first")))
    ) / F.lit(3.6e9) + 1
    hours = F.lit(expected_hours) if expected_hours else span
    return sizes.agg(F.avg("_rows").alias("mean_records"), hours.cast("bigint").alias("expected_hours")).withColumn(
        "completeness_pct", F.try_divide(F.col("mean_records"), F.col("expected_hours")) * 100
    )


def distinct_cities(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count("city_key").alias("cities"))


def date_range(df: DataFrame, column: str = "datetime") -> DataFrame:
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"))


def source_counts(df: DataFrame, column: str = "data_source") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows"))


def city_ranking(df: DataFrame, cols=("no2", "pm10", "o3"), by: str = "city_key") -> DataFrame:
    """Cities by mean level of each pollutant, the highest first."""
    present = [c for c in cols if c in df.columns]
    means = _means(df, [by], present).unpivot([by], present, "pollutant", "mean_level")
    ranked = means.filter(F.col("mean_level").isNotNull())
    order = Window.partitionBy("pollutant").orderBy(F.col("mean_level").desc())
    return ranked.withColumn("rank", F.rank().over(order))


def null_counts(df: DataFrame, cols=None, by=()) -> DataFrame:
    """column, nulls, null_pct from one pass over the table."""
    by = list(by)
    cols = [c for c in (cols or df.columns) if c not in (*by, SEQ)]
    aggs = [F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]]
    counted = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    long = counted.unpivot([*by, "_rows"], cols, "column", "nulls")
    return long.select(*by, "column", "nulls", (F.try_divide(F.col("nulls"), F.col("_rows")) * 100).alias("null_pct"))
