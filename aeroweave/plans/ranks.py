"""Exact average ranks without putting a column into one order in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.plans.chunks import CHUNK
from aeroweave.plans.shared import written
from aeroweave.plans.small import broadcast_if_small

#: A value that more than this share of its group has, and so many rows, is hot: at most 1 / HOT_SHARE values of a group are.
HOT_SHARE = 0.002
HOT_ROWS = 10_000


def average_ranks(counts: DataFrame, by, value: str, n: str = "n") -> DataFrame:
    """``counts`` (one row per group and value, with its number of rows) with ``rank``, the mean rank of these rows, and ``total``.

    Values are range-partitioned by group and value, so a group of any size spreads over tasks. A window inside each
    partition counts up; what lies in earlier partitions of the group is a table of one row per partition and group.
    Equal values are one row, so a tie never lies on a border. Ranks begin at 1.
    """
    by = list(by)
    if not by:
        raise ValueError("ranks need a group; use a constant column for one order")
    ranged = written(
        counts.repartitionByRange(*by, value).withColumn(CHUNK, F.spark_partition_id().cast("long")), "values")
    sums = ranged.groupBy(*by, CHUNK).agg(F.sum(n).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy(CHUNK)
    whole = Window.partitionBy(*by)
    offsets = sums.select(
        *by, CHUNK, (F.sum("_rows").over(earlier) - F.col("_rows")).alias("_before"), F.sum("_rows").over(whole).alias("total"))
    inside = Window.partitionBy(*by, CHUNK).orderBy(value)
    upto = ranged.withColumn("_upto", F.sum(n).over(inside))
    # borders are a row per partition and group: the join is left to adaptive execution
    rank = F.col("_before") + F.col("_upto") - (F.col(n) - 1) / 2.0
    return upto.join(offsets, [*by, CHUNK]).select(*counts.columns, rank.alias("rank"), "total")


def attach_by_value(rows: DataFrame, values: DataFrame, by, value: str, n: str = "n", total: str = "total") -> DataFrame:
    """Inner join of ``rows`` with one row per group and value, in which no value's rows meet in one task.

    Hot values, of which a group has at most 1 / HOT_SHARE, are broadcast if they are counted to be few (with very many groups
    they may not be, and the join is left to adaptive execution); rows of all other values are shuffled to them, and each is a
    small share of its group, or few rows.
    """
    by = list(by)
    on = [*by, value]
    is_hot = (F.col(n) > F.col(total) * HOT_SHARE) & (F.col(n) > HOT_ROWS)
    kept = [c for c in values.columns if c not in on]
    hot = values.filter(is_hot).select(*on, F.struct(*kept).alias("_hot"))
    marked = rows.join(broadcast_if_small(hot), on, "left")
    found = marked.filter("_hot is not null").select(*rows.columns, "_hot.*")
    others = marked.filter("_hot is null").drop("_hot").join(values.filter(~is_hot), on)
    return found.unionByName(others.select(*found.columns))
