"""Density clusters (DBSCAN) over a grid whose dense cells are never looked at row by row."""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.plans.graphs import components
from aeroweave.plans.shared import written
from aeroweave.plans.small import broadcast_if_small

#: Parts with so many points at most are compared point by point.
DIRECT_POINTS = 32
#: Cells are cut in two along each axis so often while rows are counted. Only parts that are still undecided are read and cut further.
BASE = 3
DEEPEST = 40


def _summed(gaps: list[Column]) -> Column:
    return reduce(lambda s, g: s + g * g, gaps, F.lit(0.0))


def _axes(dimensions: int, *names: str) -> list[list[Column]]:
    return [[F.col(c)[i] for c in names] for i in range(dimensions)]


def _distance(a: str, b: str, dimensions: int) -> Column:
    return _summed([x - y for x, y in _axes(dimensions, a, b)])


def _bounds(lo_a: str, hi_a: str, lo_b: str, hi_b: str, dimensions: int) -> tuple[Column, Column]:
    """Squared least and greatest distance of two boxes. They round as :func:`_distance` does, so neither contradicts it."""
    axes = _axes(dimensions, lo_a, hi_a, lo_b, hi_b)
    gap = _summed([F.greatest(la - hb, lb - ha, F.lit(0.0)) for la, ha, lb, hb in axes])
    return gap.alias("gap"), _summed([F.greatest(ha - lb, hb - la) for la, ha, lb, hb in axes]).alias("reach")


def _neighbours(dimensions: int) -> list[tuple[int, ...]]:
    """Offsets of the cells that can hold a point within eps of a cell's; the cell itself is left out.

    Cells have sides of eps / sqrt(dimensions), and offsets whose least distance exceeds eps are not listed.
    """
    reach = ceil(sqrt(dimensions))
    near = lambda o: sum(max(abs(x) - 1, 0) ** 2 for x in o) <= dimensions + 1e-9
    return [o for o in product(range(-reach, reach + 1), repeat=dimensions) if any(o) and near(o)]


def _moved(cell: str, offsets) -> Column:
    return F.explode(F.array(*[F.array(*[(F.col(cell)[i] + o).cast("long") for i, o in enumerate(offset)]) for offset in offsets]))


def _part(at: list[Column], level: int, above: int = 0) -> Column:
    """The part of the grid a point is in, or the one so many levels above it. Parts of level 0 are the cells."""
    return F.array(*[F.shiftright(F.floor(x * (sqrt(len(at)) * 2.0**level)).cast("long"), above) for x in at])


def _above(part: str, levels: int, dimensions: int) -> Column:
    """The part so many levels up that holds a part."""
    return F.array(*[F.shiftright(F.col(part)[i], levels) for i in range(dimensions)])


class _Parts:
    """The parts of every level: part, above (the part it was cut from; itself on level 0), size, n, lo and hi.

    Down to BASE they add up those of ``base``. Further parts are made of ``points`` (at, n, part on level BASE) of the parts
    that :meth:`look_into` was given.
    """

    def __init__(self, base: DataFrame, read, dimensions: int):
        self.base, self.read, self.dimensions, self.points = base, read, dimensions, None

    def look_into(self, parts: DataFrame) -> None:
        self.points = written(self.read(broadcast_if_small(written(parts.distinct(), "open-parts"))), "open-points")

    def placed(self, level: int) -> DataFrame:
        at = [F.col("at")[i] for i in range(self.dimensions)]
        return self.points.select("at", "n", _part(at, level).alias("part"))

    def level(self, level: int) -> DataFrame:
        axes = range(self.dimensions)
        if level <= BASE:
            source, lo, hi, size = self.base.withColumn("part", _above("part", BASE - level, self.dimensions)), "lo", "hi", F.sum("size")
        else:
            source, lo, hi, size = self.placed(level), "at", "at", F.count("*")
        found = source.groupBy("part").agg(
            size.alias("size"), F.sum("n").alias("n"),
            F.array(*[F.min(F.col(lo)[i]) for i in axes]).alias("lo"), F.array(*[F.max(F.col(hi)[i]) for i in axes]).alias("hi"))
        return found.withColumn("above", _above("part", 1 if level else 0, self.dimensions))


def _weights(asking: DataFrame, parts: _Parts, enough: int) -> DataFrame:
    """at, cell and weight: the rows of each near cell within distance 1 of the points of ``asking`` (at, cell), if there are any.

    Weights are exact for points whose sum is below ``enough``; others are done as soon as they have as many. Boxes around parts
    tell whether all of their points are within reach or none are, and only what is undecided is looked into.
    """
    size = parts.dimensions
    near = [(0,) * size, *_neighbours(size)]
    frontier = asking.select("at", _moved("cell", near).alias("cell")).withColumn("above", F.col("cell"))
    sure, direct = [], []
    for level in range(DEEPEST + 1):
        measured = frontier.join(parts.level(level), "above").select(
            "at", "cell", "part", "size", "n", *_bounds("at", "at", "lo", "hi", size))
        measured = written(measured.filter("gap <= 1.0"), "near-parts")
        sure.append(measured.filter("reach <= 1.0").groupBy("at", "cell").agg(F.sum("n").alias("weight")))
        held = reduce(DataFrame.unionByName, sure).groupBy("at").agg(F.sum("weight").alias("weight"))
        left = written(measured.filter("reach > 1.0").join(held.filter(F.col("weight") >= enough), "at", "left_anti"), "near-parts")
        if left.isEmpty():
            break
        if level == BASE:
            parts.look_into(left.select("part"))
        if level >= BASE:
            small = (F.col("size") <= DIRECT_POINTS) | F.lit(level == DEEPEST)
            direct.append((level, left.filter(small)))
            left = left.filter(~small)
        frontier = left.select("at", "cell", F.col("part").alias("above"))
    for level, undecided in direct:
        points = parts.placed(level).select("part", F.col("at").alias("other"), F.col("n").alias("weight"))
        met = undecided.select("at", "cell", "part").join(points, "part").filter(_distance("at", "other", size) <= 1.0)
        sure.append(met.groupBy("at", "cell").agg(F.sum("weight").alias("weight")))
    return reduce(DataFrame.unionByName, sure).groupBy("at", "cell").agg(F.sum("weight").alias("weight"))


def _linked_cells(parts: _Parts) -> DataFrame:
    """Pairs of neighbouring cells, a before b, of which some core points are within distance 1.

    Pairs of parts go down together. Boxes around a part's points tell that all of two parts are within reach, which links the
    cells, or that none are; only what is undecided is looked into, until parts are small enough to be compared point by point.
    """
    size = parts.dimensions
    ahead = [o for o in _neighbours(size) if o > (0,) * size]
    side = lambda table, s: table.select(*[F.col(c).alias(f"{c}_{s}") for c in ("part", "above", "size", "lo", "hi")])
    links, direct, frontier = [], [], None
    for level in range(DEEPEST + 1):
        table = parts.level(level)
        if frontier is None:
            pairs = side(table, "a").withColumn("a", F.col("part_a")).withColumn("b", _moved("a", ahead)).join(
                side(table, "b"), F.col("b") == F.col("above_b"))
        else:
            pairs = frontier.join(side(table, "a"), F.col("pa") == F.col("above_a")).join(side(table, "b"), F.col("pb") == F.col("above_b"))
        measured = written(pairs.select(
            "a", "b", F.col("part_a").alias("pa"), F.col("part_b").alias("pb"), "size_a", "size_b",
            *_bounds("lo_a", "hi_a", "lo_b", "hi_b", size)).filter("gap <= 1.0"), "cell-pairs")
        found = measured.filter("reach <= 1.0").select("a", "b").distinct()
        links.append(found)
        left = written(measured.filter("reach > 1.0").join(found, ["a", "b"], "left_anti"), "cell-pairs")
        if left.isEmpty():
            break
        if level == BASE:
            parts.look_into(left.select(F.explode(F.array("pa", "pb")).alias("part")))
        if level >= BASE:
            small = ((F.col("size_a") <= DIRECT_POINTS) & (F.col("size_b") <= DIRECT_POINTS)) | F.lit(level == DEEPEST)
            direct.append((level, left.filter(small)))
            left = left.filter(~small)
        frontier = left.select("a", "b", "pa", "pb")
    for level, undecided in direct:
        both = undecided.select("a", "b", "pa", "pb")
        for s in "ab":
            both = both.join(parts.placed(level).select(F.col("part").alias(f"p{s}"), F.col("at").alias(f"at_{s}")), f"p{s}")
        links.append(both.filter(_distance("at_a", "at_b", size) <= 1.0).select("a", "b").distinct())
    return reduce(DataFrame.unionByName, links).distinct()


def density_clusters(
    df: DataFrame, features, eps: float, min_rows: int = 5, id_column: str = "event_id", cluster: str = "cluster", kind: str = "cluster_role",
) -> DataFrame:
    """``df`` with the cluster of each row (the least id of its core rows, null for noise) and its role: core, border or noise.

    A row is core when at least ``min_rows`` rows, itself included, are within ``eps`` (Euclidean). Core rows within ``eps`` of each other
    share a cluster. Other rows within ``eps`` of a core row are its border; one that several clusters reach goes to the
    one of least id. Rows with an unknown or infinite feature have null for both. Ids of core rows should be known.

    Cells have a diagonal of ``eps``, so all rows of a cell of ``min_rows`` are core and linked without a look at them. Rows are
    counted once, by parts of cells with a box around each; what follows works on parts. Rows of other cells, fewer than ``min_rows``
    in each, are points of their own that count the rows around them (:func:`_weights`), neighbouring cells are linked
    (:func:`_linked_cells`), and components are found on cells. Both read rows only of parts that boxes leave undecided.
    """
    if eps <= 0 or min_rows < 1:
        raise ValueError("eps and min_rows must be above zero")
    features = list(features)
    size, names = len(features), [f"_f{i}" for i in range(len(features))]
    value = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double") + 0.0)
    numbered = df.withColumns({n: value(c) for c, n in zip(features, names)})
    own = [F.col(n) / F.lit(float(eps)) for n in names]
    at = F.array(*[F.col(n) for n in names])
    rows = written(numbered.dropna(subset=names).select(
        *[o.alias(n) for o, n in zip(own, names)], F.col(id_column).alias("id")), "cluster-rows")
    placed = rows.withColumn("part", _part([F.col(n) for n in names], BASE))
    boxes = [F.array(*[f(n) for n in names]).alias(c) for c, f in (("lo", F.min), ("hi", F.max))]
    counted = [F.count("*").alias("size"), F.count("*").alias("n"), *boxes, F.min("id").alias("id")]
    base = written(placed.groupBy("part").agg(*counted), "cluster-parts")
    by_cell = lambda parts: parts.groupBy(_above("part", BASE, size).alias("cell"))
    cells = written(by_cell(base).agg(F.sum("n").alias("weight")), "cluster-cells")
    if cells.isEmpty():
        return df.withColumns({cluster: F.lit(None).cast(dict(df.dtypes)[id_column]), kind: F.lit(None).cast("string")})

    def points_of(parts: DataFrame) -> DataFrame:
        """Different points of parts of level BASE."""
        return placed.join(parts, "part", "left_semi").groupBy(at.alias("at"), "part").agg(F.count("*").alias("n"))

    sparse_cells = cells.filter(F.col("weight") < min_rows).select("cell")
    single = None
    if sparse_cells.isEmpty():
        core_base, core_points = base, points_of
    else:
        in_sparse = placed.withColumn("cell", _above("part", BASE, size)).join(broadcast_if_small(sparse_cells), "cell", "left_semi")
        points = written(in_sparse.groupBy("cell", at.alias("at")).agg(F.min("id").alias("id"), F.count("*").alias("n")), "sparse-points")
        weights = written(_weights(points.select("at", "cell"), _Parts(base, points_of, size), min_rows), "weights")
        summed = weights.groupBy("at").agg(F.sum("weight").alias("weight"))
        # every point finds itself
        single = written(points.join(summed, "at").select("cell", "at", "id", "n", (F.col("weight") >= min_rows).alias("core")), "sparse-points")
        axes = [F.col("at")[i] for i in range(size)]
        core_single = single.filter("core").select(*[x.alias(n) for x, n in zip(axes, names)], "id", "n")
        alone = core_single.withColumn("part", _part([F.col(n) for n in names], BASE)).groupBy("part").agg(
            F.count("*").alias("size"), F.sum("n").alias("n"), *boxes, F.min("id").alias("id"))
        in_dense = base.withColumn("cell", _above("part", BASE, size)).join(broadcast_if_small(sparse_cells), "cell", "left_anti").drop("cell")
        core_base = written(in_dense.unionByName(alone), "core-parts")
        core_points = lambda parts: points_of(parts).join(single.filter("not core").select("at"), "at", "left_anti")

    linked = _linked_cells(_Parts(core_base, core_points, size))
    grouped = components(linked)
    labelled = by_cell(core_base).agg(F.min("id").alias("least")).join(
        grouped, F.col("cell") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cell"))
    labelled = written(labelled.select("cell", "least", "component"), "cell-components")
    least = labelled.groupBy("component").agg(F.min("least").alias("cluster"))
    labels = labelled.join(least, "component").select("cell", "cluster")
    nowhere = F.lit(None).cast("array<double>").alias("at")
    if single is None:
        found = labels.select("cell", nowhere, "cluster", F.lit("core").alias("role"))
    else:
        labels = written(labels, "cell-clusters")
        dense = labels.join(broadcast_if_small(sparse_cells), "cell", "left_anti")
        cores = written(single.filter("core").join(labels, "cell").select("cell", "at", "cluster"), "sparse-cores")
        others = single.filter("not core").select("cell", "at")
        looked = others.select(F.col("at").alias("own"), "cell", _moved("cell", [(0,) * size, *_neighbours(size)]).alias("near"))
        reached = looked.join(cores.select(F.col("cell").alias("near"), "at", "cluster"), "near").filter(
            _distance("own", "at", size) <= 1.0).select("cell", F.col("own").alias("at"), "cluster")
        in_reach = weights.withColumnRenamed("cell", "near").join(dense.withColumnRenamed("cell", "near"), "near").join(others, "at")
        border = reached.unionByName(in_reach.select("cell", "at", "cluster")).groupBy("cell", "at").agg(F.min("cluster").alias("cluster"))
        found = dense.select("cell", nowhere, "cluster", F.lit("core").alias("role")).unionByName(
            cores.withColumn("role", F.lit("core"))).unionByName(border.withColumn("role", F.lit("border")))
    found = written(found, "clusters").toDF("_cell", "_at", "_cluster", "_role")
    # a dense cell has one row for all of its points, another cell one for each, fewer than min_rows
    same = (F.col("_home") == F.col("_cell")) & (F.col("_at").isNull() | (F.col("_own") == F.col("_at")))
    result = numbered.withColumns({"_home": _part(own, BASE, BASE), "_own": F.array(*own)}).join(broadcast_if_small(found), same, "left")
    all_known = F.lit(True)
    for n in names:
        all_known = all_known & F.col(n).isNotNull()
    return result.withColumns({
        cluster: F.col("_cluster"), kind: F.when(all_known, F.coalesce("_role", F.lit("noise")))}).select(*df.columns, cluster, kind)
