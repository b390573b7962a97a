"""Filling unknown measures from the nearest rows that know them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.plans import cells
from aeroweave.plans.shared import written

K = 5


def impute_by_neighbours(df: DataFrame, target: str, predictors, k: int = K, filled: str | None = None) -> DataFrame:
    """``df`` with ``filled``: the target, or where that is unknown, its mean over the ``k`` nearest rows that know it.

    Distance is Euclidean over predictors divided by their standard deviation among rows that know everything; predictors that
    do not vary are left out of it. All rows as far as the kth take part, so the result does not depend on an order. Rows whose
    predictors are not all known stay unknown, and so does everything where no row knows target and predictors; with fewer than
    ``k`` such rows all of them count. Infinite and NaN values are unknown.

    Equal rows are one point. Points are in a tree of cells that are cut until they hold few, and all unknown rows go down that
    tree together (:func:`cells.near_leaves`): no row is compared with more than the leaves around it.
    """
    predictors, filled = list(predictors), filled or f"{target}_filled"
    value = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double"))
    names = [f"_p{i}" for i in range(len(predictors))]
    narrow = df.select(*[value(c).alias(n) for c, n in zip(predictors, names)], value(target).alias("_t")).dropna(subset=names)
    donors = narrow.filter("_t is not null").groupBy(*names).agg(F.count("*").alias("n"), F.sum("_t").alias("total"))
    asking = narrow.filter("_t is null").select(*names).distinct()
    spread = narrow.agg(
        *[F.stddev_pop(F.when(F.col("_t").isNotNull(), F.col(n))).alias(f"s{n}") for n in names],
        *[f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max)]).first()
    used = [n for n in names if (spread[f"s{n}"] or 0.0) > 0]
    if not used:  # no distance tells rows apart: all donors are as near
        mean = donors.agg((F.sum("total") / F.sum("n")).alias("_mean"))
        known = reduce(lambda a, b: a & b, [value(c).isNotNull() for c in predictors], F.lit(True))
        return df.crossJoin(F.broadcast(mean)).withColumn(  # one row
            filled, F.coalesce(value(target), F.when(known, F.col("_mean")))).drop("_mean")
    # one scale for all axes, so that cells are square in the distance that counts
    width = max((spread[f"max{n}"] - spread[f"min{n}"]) / spread[f"s{n}"] for n in used) * (1 + 1e-9)
    at = F.array(*[(F.col(n) - F.lit(spread[f"min{n}"])) / F.lit(spread[f"s{n}"]) / F.lit(width) for n in used])
    own = F.array(*names)
    tree = cells.build(donors.select(at.alias("at"), own.alias("own"), "n", "total"), len(used)) if not donors.isEmpty() else None
    if tree is None:
        return df.withColumn(filled, value(target))
    places = asking.select(at.alias("place"), own.alias("asks"))
    leaves = cells.near_leaves(places, tree, k)
    scales = F.array(*[F.lit(spread[f"s{n}"]) if n in used else F.lit(None).cast("double") for n in names])
    gaps = F.zip_with(F.zip_with("asks", "own", lambda a, b: a - b), scales, lambda g, s: F.coalesce(g / s, F.lit(0.0)))
    found = leaves.join(tree.points.select("level", "cell", "own", "n", "total"), ["level", "cell"]).withColumn(
        "distance", F.aggregate(gaps, F.lit(0.0), lambda a, g: a + g * g))
    # a place's candidates are those of a few leaves
    nearest = Window.partitionBy("asks").orderBy("distance").rangeBetween(Window.unboundedPreceding, 0)
    counted = found.withColumn("held", F.sum("n").over(nearest)).withColumn(
        "before", F.col("held") - F.sum("n").over(Window.partitionBy("asks", "distance")))
    means = counted.filter(F.col("before") < k).groupBy("asks").agg((F.sum("total") / F.sum("n")).alias("_mean"))
    means = written(means.select(*[F.col("asks")[i].alias(n) for i, n in enumerate(names)], "_mean"), "neighbours")
    on = reduce(lambda a, b: a & b, [value(c) == F.col(n) for c, n in zip(predictors, names)], value(target).isNull())
    return df.join(means, on, "left").withColumn(filled, F.coalesce(value(target), F.col("_mean"))).drop(*names, "_mean")
