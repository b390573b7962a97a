"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import discard, written


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (``a``, ``b``, both long): root is the least node it reaches.

    Rounds of large-star and small-star steps, O(log^2) of them, each an aggregation and a join written to the shared
    folder. Roots, which are not listed as nodes of other roots, get themselves.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select(F.col("v"), F.col("u")))
        least = both.groupBy(F.col("u").alias("x")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("x")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("x"))
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct()
        after = written(small, "edges")
        before, state = state, _state(after)
        discard(now)
        now = after
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)
