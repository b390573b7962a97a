"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from aeroweave.operators.schema import objects_to_string

WRITABLE = ("parquet", "csv", "json")

# text formats keep only milliseconds unless told otherwise
TEXT_TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write one format, named explicitly."""
    if fmt not in WRITABLE:
        raise ValueError(f"unsupported format: {fmt}")
    writer = df.write.mode(mode).format(fmt)
    if fmt != "parquet":
        writer = writer.option("timestampNTZFormat", TEXT_TIMES)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def save_dual(df: DataFrame, base: str, mode: str = "overwrite") -> DataFrame:
    """Write ``base.parquet`` and ``base.csv`` with dates as text; returns what was written.

    The CSV is made from the Parquet copy, so the plan behind ``df`` runs once and nothing
    has to be cached.
    """
    save(objects_to_string(df), f"{base}.parquet", "parquet", mode)
    written = df.sparkSession.read.parquet(f"{base}.parquet")
    save(written, f"{base}.csv", "csv", mode)
    return written


def save_by_city(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per city.

    Rows are gathered by city so that small cities get one file; adaptive execution splits
    a city that is too large for one task.
    """
    if "city_key" not in df.columns:
        raise ValueError("no city_key column found")
    df.hint("rebalance", "city_key").write.mode(mode).partitionBy("city_key").parquet(path)
