"""Points in a tree of square cells, searched for many places at once, level by level."""

from __future__ import annotations

from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.plans.shared import discard, written
from aeroweave.plans.small import broadcast_if_small

#: A cell is split into 2 ** STEP parts along each axis.
STEP = 2
#: Cells of so many points are not split.
LEAF_POINTS = 64
#: Steps to where doubles in [0, 1) still tell parts apart.
DEEPEST = 25
#: Bounds are widened by this share, so that rounding can't cut off a point.
SLACK = 1e-9


class Cells(NamedTuple):
    """Cells of each level, and points with the leaf they are in."""

    levels: list[DataFrame]  # cell, points, n, leaf
    points: DataFrame  # at, n, further columns, level, cell
    dimensions: int


def cell_of(at: Column, level: int) -> Column:
    return F.transform(at, lambda x: F.floor(x * float(2 ** (STEP * level))).cast("long"))


def _squared(gaps: Column) -> Column:
    return F.aggregate(gaps, F.lit(0.0), lambda a, g: a + g * g)


def least_distance(at: Column, cell: Column, level: int) -> Column:
    """Squared distance from a place to the nearest point of a cell."""
    side = 1.0 / 2 ** (STEP * level)
    return _squared(F.zip_with(at, cell, lambda x, c: F.greatest(c * side - x, x - (c + 1) * side, F.lit(0.0))))


def most_distance(at: Column, cell: Column, level: int) -> Column:
    """Squared distance from a place to the farthest point of a cell."""
    side = 1.0 / 2 ** (STEP * level)
    return _squared(F.zip_with(at, cell, lambda x, c: F.greatest(x - c * side, (c + 1) * side - x)))


def children(cell: str, dimensions: int) -> Column:
    """An array of the parts of a cell."""
    parts = list(product(range(2**STEP), repeat=dimensions))
    return F.array(*[
        F.array(*[F.col(cell)[i] * (2**STEP) + offset for i, offset in enumerate(part)]) for part in parts])


def build(points: DataFrame, dimensions: int) -> Cells:
    """The tree of ``points``: ``at`` (an array of doubles in [0, 1)), different in each row, and ``n``, the rows it stands for.

    Cells of more than LEAF_POINTS are split, so dense places are cut until they are not. A level is one count of the points that
    no leaf holds yet.
    """
    still_open, settled, levels = points, [], []
    for level in range(DEEPEST + 1):
        placed = still_open.withColumn("cell", cell_of(F.col("at"), level))
        counts = placed.groupBy("cell").agg(F.count("*").alias("points"), F.sum("n").alias("n"))
        cells = written(counts.withColumn("leaf", (F.col("points") <= LEAF_POINTS) | F.lit(level == DEEPEST)), "cells")
        levels.append(cells)
        known = placed.join(broadcast_if_small(cells.select("cell", "leaf")), "cell").withColumn("level", F.lit(level))
        known = written(known, "cell-points")
        settled.append(known.filter("leaf").drop("leaf"))
        still_open = known.filter("not leaf").select(*points.columns)
        if still_open.isEmpty():
            break
    return Cells(levels, reduce(DataFrame.unionByName, settled), dimensions)


def _start(places: DataFrame, tree: Cells) -> DataFrame:
    root = tree.levels[0].select(F.col("cell"), "n", "leaf", F.lit(0).alias("level"))
    return places.crossJoin(F.broadcast(root))  # one row


def _deeper(frontier: DataFrame, tree: Cells, level: int) -> DataFrame:
    """Inner cells of a frontier replaced by those of their parts that hold points."""
    parts = frontier.filter("not leaf").drop("n", "leaf", "level").withColumn("cell", F.explode(children("cell", tree.dimensions)))
    found = parts.join(broadcast_if_small(tree.levels[level]).drop("points"), "cell").withColumn("level", F.lit(level))
    return frontier.filter("leaf").unionByName(found.select(*frontier.columns))


def _by_level(frontier: DataFrame, depth: int, distance) -> Column:
    """A distance to cells of several levels."""
    found = F.lit(None).cast("double")
    for level in range(depth + 1):
        found = F.when(F.col("level") == level, distance(F.col("place"), F.col("cell"), level)).otherwise(found)
    return found


def near_leaves(places: DataFrame, tree: Cells, k: int) -> DataFrame:
    """``places`` (place, ...) with the level and cell of each leaf that may hold one of its k nearest rows.

    A place's frontier is a handful of cells. On every level those farther off than cells that hold k rows for sure are
    left out, so a dense cell is looked into only where it is close.
    """
    frontier = _start(places, tree)
    whole = Window.partitionBy("place").orderBy("far").rangeBetween(Window.unboundedPreceding, 0)
    for level in range(len(tree.levels)):
        if level:
            frontier = _deeper(frontier, tree, level)
        measured = frontier.withColumns({
            "near": _by_level(frontier, level, least_distance), "far": _by_level(frontier, level, most_distance)})
        reached = measured.withColumn("held", F.sum("n").over(whole))
        bound = F.min(F.when(F.col("held") >= k, F.col("far"))).over(Window.partitionBy("place"))
        close = reached.withColumn("bound", bound).filter(F.col("bound").isNull() | (F.col("near") <= F.col("bound") * (1 + SLACK)))
        narrowed = written(close.select(*frontier.columns), "frontier")
        frontier = narrowed
    return frontier.select(*places.columns, "level", "cell")


def forget(tree: Cells) -> None:
    """Delete the tree's tables of cells."""
    discard(*tree.levels)
