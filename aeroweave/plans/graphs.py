"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.plans.shared import discard, written


def _stars(links: DataFrame) -> bool:
    """Whether every node points to one other node at most, and to one that points to none."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    counted = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return counted.filter("out > 1 or (out = 1 and into = 1)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component, the least node that links lead to, for every node of a link.

    Rounds of large and small stars: each node hands its larger, then its smaller neighbours on to the least node it knows. Links get
    no more, and after about log2 of the longest way squared rounds, usually a handful, all point to the least node. A node's links
    are aggregated and joined, never gathered in one row.
    """
    ordered = lambda df: df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(ordered(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.join(least, F.col("u") == F.col("w")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        middle = written(ordered(large), "links")
        small_least = middle.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        joined = middle.join(small_least, F.col("u") == F.col("w"))
        after = written(ordered(joined.select("v", "m").withColumnsRenamed({"v": "u", "m": "v"}).unionByName(
            small_least.select(F.col("w").alias("u"), F.col("m").alias("v")))), "links")
        discard(now, middle)
        now = after
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
