"""Cutting each key's ordered history into chunks small enough for one task.

A window over a whole city cannot be spread over tasks, and one city may hold a third
of all rows. So order-dependent operators work in two steps: a window inside
``(key, chunk)``, plus what has to be carried over from neighbouring chunks, which is a
table of one row per chunk.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.calendar import hour_floor, micros
from aeroweave.session import ensure_checkpoint_dir

CHUNK = "_chunk"
TARGET_ROWS = 500_000
HOUR_US = 3_600_000_000


class Density(NamedTuple):
    """How tightly rows are packed in time."""

    rows: int
    rows_in_hottest_hour: int
    first_us: int
    last_us: int


class Chunked(NamedTuple):
    df: DataFrame
    single: bool  # True when every key fits into one chunk, so nothing is carried over


def measure_density(df: DataFrame, keys, ts: str) -> Density:
    """One narrow job returning one row: the fullest hour of any key, and the time range."""
    hours = df.groupBy(*keys, hour_floor(F.col(ts)).alias("_hour")).agg(F.count("*").alias("_n"))
    row = hours.agg(
        F.sum("_n").alias("rows"),
        F.max("_n").alias("n"),
        micros(F.min("_hour")).alias("first"),
        micros(F.max("_hour")).alias("last"),
    ).first()
    return Density(row["rows"] or 0, row["n"] or 0, row["first"] or 0, row["last"] or 0)


def in_chunks(
    df: DataFrame, keys, order, target_rows: int = TARGET_ROWS, density: Density | None = None
) -> Chunked:
    """Add ``_chunk``, a number that never decreases along ``order`` within a key.

    ``order`` starts with the time column. Chunks are equal spans of time, sized so that
    none exceeds ``target_rows``. When a single hour of one key is already larger than
    that, equal spans cannot help: the rows are range-partitioned by key and full order
    instead, and the partition number is the chunk. That number must be the same for
    every later reader, hence the checkpoint. Unknown times sort first, so they make up the
    lowest chunk.
    """
    ts = order[0]
    density = density or measure_density(df, keys, ts)
    if density.rows_in_hottest_hour <= target_rows:
        width = target_rows // max(density.rows_in_hottest_hour, 1) * HOUR_US
        chunk = F.coalesce(F.floor((micros(F.col(ts)) - F.lit(density.first_us)) / F.lit(width)), F.lit(-1).cast("long"))
        single = density.last_us + HOUR_US - density.first_us <= width
        return Chunked(df.withColumn(CHUNK, F.lit(0).cast("long") if single else chunk), single)
    ensure_checkpoint_dir(df.sparkSession)
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(configured, -(-density.rows // max(target_rows, 1)))
    ranged = df.repartitionByRange(wanted, *keys, *order)
    return Chunked(ranged.withColumn(CHUNK, F.spark_partition_id().cast("long")).checkpoint(), False)


def order_key(order) -> Column:
    """The order as one comparable value, which is known even where the time is not."""
    return F.struct(*order)


def join_known_or_not(df: DataFrame, other: DataFrame, on) -> DataFrame:
    """Left join on columns of which unknown values are equal to each other."""
    renamed = other.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return df.join(renamed, same, "left").drop(*[f"_on_{c}" for c in on])
