"""Isolation forest: how few random cuts set a row apart."""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.plans.shared import written

TREES, SAMPLE, SEED = 100, 256, 7
#: Arrivals per tree that are looked at, as a multiple of the sample; ten standard deviations above it.
_CANDIDATES = 2.0
_EULER = 0.5772156649015329


def usual_path(n):
    """Mean depth of a point in a random tree over n different points."""
    n = np.asarray(n, float)
    with np.errstate(all="ignore"):
        long = 2.0 * (np.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers stirred well."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _waits(keys: np.ndarray, trees: np.ndarray, turn: int, seed: int) -> np.ndarray:
    """Exponential waiting times of mean 1, the same for the same point, tree and turn."""
    with np.errstate(over="ignore"):
        drawn = _mixed(_mixed(_mixed(keys ^ np.uint64(seed)) + trees.astype(np.uint64)) + np.uint64(turn))
    return -np.log((drawn >> np.uint64(11)).astype(float) / 2.0**53 + 2.0**-54)


def sampled(points: DataFrame, rows: int, trees: int, sample: int, seed: int) -> DataFrame:
    """tree, at, values: the rows each tree learns from, in the order ``at`` of their arrival.

    A point of n equal rows arrives at random, n times in a unit of time on average; the first arrivals of all points are
    a sample of rows in which equal ones count as many. It depends on nothing but values and seed, and a point of very many
    rows is one row here.
    """
    until = _CANDIDATES * max(sample, 64) / max(rows, 1)

    def arrivals(frames):
        for pdf in frames:
            keys = pdf["key"].to_numpy().astype(np.int64).view(np.uint64)
            rate = pdf["n"].to_numpy(float)
            first = _waits(keys[:, None], np.arange(trees)[None], 0, seed) / rate[:, None]
            point, tree = np.nonzero(first < until)
            at, turn, found = first[point, tree], 0, []
            while len(point):
                found.append(pd.DataFrame({"tree": tree, "at": at, "values": pdf["values"].to_numpy()[point]}))
                turn += 1
                at = at + _waits(keys[point], tree, turn, seed) / rate[point]
                soon = at < until
                point, tree, at = point[soon], tree[soon], at[soon]
            if found:
                yield pd.concat(found)

    return points.mapInPandas(arrivals, "tree int, at double, values array<double>")


def grow(values: np.ndarray, limit: int, random: np.random.Generator):
    """feature, cut, left, right and depth added at each node; leaves have feature -1."""
    nodes: list[list] = []
    stack = [(np.arange(len(values)), 0, None, 0)]
    while stack:
        held, depth, parent, side = stack.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent][2 + side] = me
        own = values[held]
        low, high = own.min(axis=0), own.max(axis=0)
        can = np.flatnonzero(low < high)
        if depth >= limit or not len(can):
            nodes.append([-1, 0.0, 0, 0, depth + float(usual_path(len(held)))])
            continue
        feature = int(random.choice(can))
        cut = float(random.uniform(low[feature], high[feature]))
        goes = own[:, feature] < cut
        if not goes.any():  # the cut fell on the least value
            goes = own[:, feature] <= low[feature]
            cut = float(np.nextafter(low[feature], np.inf))
        nodes.append([feature, cut, 0, 0, 0.0])
        stack += [(held[~goes], depth + 1, me, 1), (held[goes], depth + 1, me, 0)]
    return nodes


def depths(tree: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Depth at which each row of values ends, all rows going down together."""
    feature, cut, children, depth = tree[:, 0].astype(int), tree[:, 1], tree[:, 2:4].astype(int), tree[:, 4]
    node = np.zeros(len(values), int)
    while True:
        inner = feature[node] >= 0
        if not inner.any():
            return depth[node]
        at = node[inner]
        right = ~(values[inner, feature[at]] < cut[at])
        node[inner] = children[at, right.astype(int)]


def isolation_scores(
    df: DataFrame, features, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED, score: str = "anomaly_score",
) -> DataFrame:
    """``df`` with a score from 0 to 1: near 1 for rows that few random cuts set apart, below 0.5 for rows among many.

    Each of the trees learns from ``sample`` rows, chosen by hashes of their values (:func:`sampled`), and cuts a random feature
    at a random place until rows are apart or log2(sample) cuts are made. Scores are the same at any partitioning. Rows with
    an unknown or infinite feature have null and are learnt from by no tree; where there are fewer than two usable rows all have null.
    """
    features = list(features)
    numbers = [F.col(c).cast("double") for c in features]
    usable = F.lit(True)
    for v in numbers:
        usable = usable & F.coalesce(F.abs(v) < float("inf"), F.lit(False))
    values = F.array(*numbers)
    points = written(
        df.filter(usable).select(values.alias("values")).groupBy("values").agg(F.count("*").alias("n"))
        .withColumn("key", F.xxhash64("values")), "points")
    rows = points.agg(F.sum("n")).first()[0] or 0
    if rows < 2:
        return df.withColumn(score, F.lit(None).cast("double"))
    limit = ceil(log2(max(sample, 2)))

    def tree_of(pdf):
        held = pdf.sort_values("at", kind="stable").head(sample)
        # arrivals at one instant would be equal points, or points in no order: their values decide
        held = held.iloc[np.lexsort([*np.stack(held["values"].to_numpy()).T[::-1], held["at"].to_numpy()])]
        number = int(pdf["tree"].iloc[0])
        nodes = grow(np.stack(held["values"].to_numpy()), limit, np.random.default_rng([seed, number]))
        return pd.DataFrame({"tree": [number], "size": [len(held)], "nodes": [np.asarray(nodes, float).ravel().tolist()]})

    # about twice the sample per tree, whatever the table's size
    grown = sampled(points, rows, trees, sample, seed).groupBy("tree").applyInPandas(tree_of, "tree int, size int, nodes array<double>")
    forest = sorted(grown.collect())
    held = [np.asarray(r["nodes"]).reshape(-1, 5) for r in forest]
    usual = float(np.mean(usual_path([max(r["size"], 2) for r in forest])))
    sent = df.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("double")
    def scored(v: pd.Series) -> pd.Series:
        known = v.notna().to_numpy()
        out = np.full(len(v), np.nan)
        if known.any():
            matrix = np.stack(v[known].to_numpy()).astype(float)
            mean = sum(depths(tree, matrix) for tree in sent.value) / len(sent.value)
            out[known] = np.exp2(-mean / usual)
        return pd.Series(out)

    found = scored(F.when(usable, values))
    return df.withColumn(score, found).withColumn(score, F.when(~F.isnan(score), F.col(score)))
