"""The end-to-end jobs: raw feeds to the unified table, the correlation study, the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroweave.functions.calendar import to_local_time
from aeroweave.operators.clean import clean_all
from aeroweave.operators.features import final_dataset, gold_features, transform_categories
from aeroweave.operators.grids import to_hourly
from aeroweave.operators import quality, stats
from aeroweave.operators.aggregates import null_counts
from aeroweave.operators.merge import gold_merge, merge_feeds, sort_city_time, study_merge
from aeroweave.operators.units import standardize_units
from aeroweave.plans.shared import written
from aeroweave.session import prepare
from aeroweave.sources.readers import scan_parquet
from aeroweave.sources.writers import save, save_dual

LOCAL = "local_datetime"
STUDY_FEEDS = ("air_quality", "weather", "traffic")
FEEDS = ("weather", "air_quality", "traffic")


def build_silver(spark: SparkSession, bronze: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Clean the feeds, keep the cities they share, write them; returns the written tables."""
    prepare(spark)
    aligned = clean_all(*(bronze[n] for n in FEEDS))
    return {n: save_dual(sort_city_time(df), f"{folder}/{n}_cleaned") for n, df in zip(FEEDS, aligned)}


def build_gold(silver: dict[str, DataFrame], folder: str | None = None) -> DataFrame:
    """Join the silver tables and add the gold features; written when a folder is given."""
    gold = gold_features(gold_merge(*(silver[n] for n in FEEDS)))
    return save_dual(sort_city_time(gold), f"{folder}/unified_data") if folder else gold


def transform_feed(df: DataFrame, feed: str) -> DataFrame:
    """Standard units, hourly grid per city, and categories by local calendar.

    Rows stay keyed by UTC because the local hour repeats once a year.
    """
    hourly = to_hourly(standardize_units(df, feed)).withColumn(LOCAL, to_local_time(F.col("datetime")))
    return transform_categories(hourly, ts=LOCAL).drop(LOCAL)


def build_final(silver: dict[str, DataFrame], how: str = "outer") -> DataFrame:
    """Transform and merge the feeds and engineer every feature; calendar features are local."""
    merged = merge_feeds(*(transform_feed(silver[n], n) for n in FEEDS), how=how)
    local = merged.withColumn(LOCAL, to_local_time(F.col("datetime")))
    return final_dataset(local, ts=LOCAL)


def run_study(spark: SparkSession, feeds: dict[str, DataFrame], folder: str) -> dict[str, DataFrame] | None:
    """The correlation study of daily feeds: merged rows, correlations, tests, regression, summary.

    The merged rows are written once and every table is made from them. None when the feeds share no city and day.
    """
    prepare(spark)
    path = f"{folder}/study.parquet"
    save(study_merge(*(feeds[n] for n in STUDY_FEEDS)), path)
    merged = scan_parquet(spark, path)
    if merged.isEmpty():
        return None
    return {
        "merged": merged, "correlations": stats.correlation_matrix(merged), "tests": stats.pearson_tests(merged),
        "scatter_tests": stats.scatter_tests(merged), "regression": stats.pollutant_regression(merged),
        "summary": stats.study_summary(merged),
    }


def run_quality(df: DataFrame, folder: str, measures=None) -> dict[str, DataFrame]:
    """The quality report as tables written below ``folder``: ranges, units, gaps in columns, statistics and outliers.

    The table is written once and every part of the report reads that copy.
    """
    spark = prepare(df.sparkSession)
    rows = written(df, "report")
    parts = {
        "ranges": quality.range_validation(rows), "units": quality.unit_verification(rows),
        "nulls": null_counts(rows, measures), "statistics": quality.summary_statistics(rows, measures),
        "outliers": quality.iqr_outliers(rows, measures),
    }
    for name, part in parts.items():
        save(part, f"{folder}/{name}.parquet")
    return {name: scan_parquet(spark, f"{folder}/{name}.parquet") for name in parts}
