"""Exact quantiles without holding a column in one task.

The built-in exact ``percentile`` keeps every distinct value of a group in one task. Here sketches, merged in levels,
first bracket each quantile between two values. One pass then counts: what lies outside of brackets is a handful of rows, one for
each stretch between two edges, and what lies inside is counted by value. Where a bracket still holds too many rows it is
counted by equal parts instead, and the part that holds the rank is the next bracket. A bracket that missed its rank is
followed by the stretch that holds it. So no task orders more than a bounded number of rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.plans.shared import written
from aeroweave.plans.small import broadcast_if_small

SKETCH_SIZE = 4096  # the rank error is about 0.07 %
MARGIN = 0.004
SKETCH_BUCKETS = 64
#: Rows of a bracket that are counted by value and put in order.
MOST_ROWS = 200_000
#: Parts that a larger bracket is counted by.
PARTS = 4096


def quantile_name(column: str, prob: float) -> str:
    return f"{column}_q{prob * 100:g}".replace(".", "_")


def _sketches(narrow: DataFrame, cols, by) -> DataFrame:
    """``_s{i}`` and ``_n{i}`` per group: sketch and count of each column, first per bucket of partitions."""
    bucket = F.pmod(F.spark_partition_id(), F.lit(SKETCH_BUCKETS)).alias("_bucket")
    parts = narrow.groupBy(*by, bucket).agg(*[
        agg for i, c in enumerate(cols)
        for agg in (F.kll_sketch_agg_double(c, SKETCH_SIZE).alias(f"_s{i}"), F.count(c).alias(f"_n{i}"))])
    return parts.groupBy(*by).agg(*[
        agg for i in range(len(cols))
        for agg in (F.kll_merge_agg_double(F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}"))).alias(f"_s{i}"),
                    F.sum(f"_n{i}").alias(f"_n{i}"))])


def _first_edges(sketches: DataFrame, count: int, probs, by, margin: float) -> DataFrame:
    """``_lo{i}`` and ``_hi{i}`` per group: for each probability the two values around it."""
    def around(i: int, side: int) -> Column:
        at = F.array(*[F.lit(min(max(p + side * margin, 0.0), 1.0)) for p in probs])
        return F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_s{i}", at))

    return sketches.select(*by, *[
        out for i in range(count) for out in (around(i, -1).alias(f"_lo{i}"), around(i, 1).alias(f"_hi{i}"))])


def _counted(narrow: DataFrame, edges: DataFrame, cols, probs, by, by_value: bool) -> DataFrame:
    """by, c, zone, key, n, least, most: rows by column, stretch between edges and, inside a bracket, value or part.

    Each row gives one cell per column; what a task sends is its cells summed up.
    """
    if by:
        joined = narrow.join(broadcast_if_small(edges), by)
        side = lambda name, i: F.col(f"_{name}{i}")
    else:
        joined, row = narrow, edges.first()
        side = lambda name, i: F.array(*[F.lit(v).cast("double") for v in row[f"_{name}{i}"] or [None] * len(probs)])
    cells = []
    for i, c in enumerate(cols):
        lows, highs, v = side("lo", i), side("hi", i), F.col(c)
        bounds = [(lows[j], highs[j]) for j in range(len(probs))]
        zone = reduce(lambda a, b: a + b, [(v >= lo).cast("int") + (v > hi).cast("int") for lo, hi in bounds])
        inside = reduce(lambda a, b: a | b, [(v >= lo) & (v <= hi) for lo, hi in bounds])
        key = v
        if not by_value:
            sorted_edges = F.array_sort(F.concat(lows, highs))
            left, right = F.get(sorted_edges, zone - 1), F.get(sorted_edges, zone)
            key = F.coalesce(F.floor(F.try_divide(v - left, right - left) * PARTS).cast("double"), F.lit(0.0))
        cells.append(F.struct(F.lit(i).alias("c"), v.alias("v"), zone.alias("zone"), F.when(inside, key).alias("key")))
    long = joined.select(*by, F.explode(F.array(*cells)).alias("_c")).select(*by, "_c.*").filter("v is not null")
    return long.groupBy(*by, "c", "zone", "key").agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))


def _located(counted: DataFrame, probs, by) -> DataFrame:
    """by, c, p, pos, total, and the values at both ranks around ``pos`` where known, with the stretch [lo, hi] of ``held`` rows they are in."""
    whole = Window.partitionBy(*by, "c")
    ranked = counted.withColumns({
        "upto": F.sum("n").over(whole.orderBy("zone", "key").rowsBetween(Window.unboundedPreceding, 0)),
        "total": F.sum("n").over(whole)}).withColumn("before", F.col("upto") - F.col("n"))
    asked = F.explode(F.array(*[F.struct(F.lit(j).alias("p"), F.lit(float(p)).alias("prob")) for j, p in enumerate(probs)]))
    each = ranked.withColumn("_p", asked).withColumn("pos", F.col("_p.prob") * (F.col("total") - 1))

    def at(rank: Column, value: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("upto")), value))

    def known(rank: Column) -> Column:
        ends = F.when((F.col("least") == F.col("most")) | (rank == F.col("before")), F.col("least"))
        return at(rank, F.coalesce(ends, F.when(rank == F.col("upto") - 1, F.col("most"))))

    low, high = F.floor("pos"), F.ceil("pos")
    near = (F.col("before") <= high) & (low < F.col("upto"))
    return each.filter(near).groupBy(*by, "c", F.col("_p.p").alias("p")).agg(
        F.max("pos").alias("pos"), F.max("total").alias("total"), known(low).alias("low"), known(high).alias("high"),
        at(low, F.col("least")).alias("lo"), at(high, F.col("most")).alias("hi"), F.sum("n").alias("held"))


def _wide(count: int, probs, value: Column, name) -> list[Column]:
    """``value`` of each column and probability as a column of its own."""
    return [F.max(F.when((F.col("c") == i) & (F.col("p") == j), value)).alias(name(i, j)) for i in range(count) for j in range(len(probs))]


def exact_quantiles(df: DataFrame, cols, probs, by=(), margin: float = MARGIN) -> DataFrame:
    """Linear-interpolated quantiles, one row per group.

    Columns are named ``{column}_q{percent}``, for example ``no2_q75``. Nulls and NaN are left out; a group without values gets
    null. The table is computed when the function is called, in two passes over ``df`` and, for brackets of more than
    MOST_ROWS rows or that missed, one more for each time they are narrowed.
    """
    cols, probs, by = list(cols), list(probs), list(by)
    if not cols:
        raise ValueError("no columns given")
    numbers = {c: F.col(c).cast("double") for c in cols}
    narrow = df.select(*by, *[F.when(~F.isnan(v), v + 0.0).alias(f"_v{i}") for i, v in enumerate(numbers.values())])
    names, size = [f"_v{i}" for i in range(len(cols))], len(cols)
    sketches = written(_sketches(narrow, names, by), "sketches")
    edges = _first_edges(sketches, size, probs, by, margin)
    largest = sketches.agg(*[F.max(f"_n{i}") for i in range(size)]).first()
    held = max((n or 0 for n in largest), default=0) * margin * 3 * len(probs)  # a little more than the sketches aim at
    part = F.col("pos") - F.floor("pos")
    quantile = F.when(part == 0, F.col("low")).otherwise(F.col("low") + (F.col("high") - F.col("low")) * part)
    while True:
        counted = _counted(narrow, edges, names, probs, by, held <= MOST_ROWS)
        found = written(_located(counted, probs, by), "ranks")
        missing = F.col("low").isNull() | F.col("high").isNull()
        left = found.filter(missing).groupBy(*by, "c").agg(F.sum("held").alias("held")).agg(F.max("held")).first()[0]
        if left is None:
            break
        held = left
        stretch = F.when(missing, F.struct("lo", "hi")).otherwise(F.struct(F.col("low").alias("lo"), F.col("high").alias("hi")))
        stretches = found.groupBy(*by).agg(*_wide(size, probs, stretch, lambda i, j: f"_e{i}_{j}"))
        edges = stretches.select(*by, *[
            F.array(*[F.col(f"_e{i}_{j}.{name}") for j in range(len(probs))]).alias(f"_{name}{i}") for i in range(size) for name in ("lo", "hi")])
    wide = _wide(size, probs, quantile, lambda i, j: quantile_name(cols[i], probs[j]))
    if by:
        return sketches.select(*by).join(found.groupBy(*by).agg(*wide), by, "left")
    result = found.agg(*wide)
    return df.sparkSession.createDataFrame([tuple(result.first())], result.schema)
