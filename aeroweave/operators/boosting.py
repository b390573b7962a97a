"""Boosted regression trees from histograms that tasks sum up, judged on folds in the order of time."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.functions.calendar import micros
from aeroweave.plans.shared import written

BINS = 64
#: The response is counted in steps of its range over this number, so that sums are whole and the same in any order.
STEPS = 2**24
MIN_LEAF = 20


class Tree(NamedTuple):
    """A complete binary tree: node i has children 2 i + 1 and 2 i + 2. A node without a split sends all to the left."""

    feature: np.ndarray  # -1 without a split
    cut: np.ndarray  # bins up to it go left
    leaf: np.ndarray  # steps, by place in the lowest row


def descend(tree: Tree, bins: np.ndarray, levels: int) -> np.ndarray:
    """Node that each row of ``bins`` (rows x features) reaches after so many levels, counted from the left."""
    node = np.zeros(len(bins), np.int64)
    for level in range(levels):
        at = node + (1 << level) - 1
        feature = tree.feature[at]
        right = (feature >= 0) & (bins[np.arange(len(bins)), np.maximum(feature, 0)] > tree.cut[at])
        node = 2 * node + right
    return node


def predict(base: int, trees: list[Tree], bins: np.ndarray, depth: int) -> np.ndarray:
    total = np.full(len(bins), base, np.int64)
    for tree in trees:
        total += tree.leaf[descend(tree, bins, depth)]
    return total


def best_split(counts: np.ndarray, sums: np.ndarray, min_leaf: int = MIN_LEAF) -> tuple[int, int] | None:
    """The (feature, cut) that lowers the squared error by most, the first of equals; ``counts`` and ``sums`` are features x bins.

    None where no cut leaves ``min_leaf`` rows on both sides and lowers the error.
    """
    left_n, left_s = counts.cumsum(axis=1)[:, :-1], sums.cumsum(axis=1)[:, :-1]
    n, s = int(counts[0].sum()), int(sums[0].sum())
    right_n, right_s = n - left_n, s - left_s
    fits = (left_n >= min_leaf) & (right_n >= min_leaf)
    if not fits.any():
        return None
    with np.errstate(all="ignore"):
        gain = left_s.astype(float) ** 2 / left_n + right_s.astype(float) ** 2 / right_n - float(s) ** 2 / n
    gain = np.where(fits, gain, -np.inf)
    at = int(np.argmax(gain))
    return divmod(at, gain.shape[1]) if gain.flat[at] > 1e-9 * float(s) ** 2 / max(n, 1) and gain.flat[at] > 0 else None


class Folds(NamedTuple):
    """Binned rows and what is needed to read them."""

    rows: DataFrame  # span, bins, y in steps
    count: int
    step: float
    low: float
    features: int


def binned(df: DataFrame, response: str, features, ts: str, folds: int, bins: int = BINS) -> Folds:
    """Rows by span of time, with bins of equal width for each feature and the response in steps.

    Time is cut into ``folds + 1`` equal spans. Edges come from the first one, which every fold learns from; what lies outside goes to
    the outer bins, and an unknown feature to the lowest bin of all.
    """
    value = lambda c: F.col(c).cast("double")
    us = micros(F.col(ts).cast("timestamp_ntz"))
    known = df.filter((F.abs(value(response)) < float("inf")) & F.col(ts).isNotNull())
    first, last, low, high = known.agg(F.min(us), F.max(us), F.min(value(response)), F.max(value(response))).first()
    schema = "span int, bins array<int>, y long"
    if first is None:
        return Folds(df.sparkSession.createDataFrame([], schema), folds, 1.0, 0.0, len(features))
    width = (last - first) // (folds + 1) + 1
    span = F.floor((us - F.lit(first)) / F.lit(width)).cast("int")
    finite = lambda c: F.when(F.abs(value(c)) < float("inf"), value(c))
    edges = known.filter(span == 0).agg(*[f(finite(c)) for c in features for f in (F.min, F.max)]).first()
    step = (high - low) / STEPS or 1.0

    def place(i: int, c: str):
        least, most = edges[2 * i], edges[2 * i + 1]
        if least is None or most <= least:
            return F.lit(0)
        at = F.floor((finite(c) - F.lit(least)) / F.lit((most - least) / (bins - 1))) + 1
        return F.coalesce(F.greatest(F.lit(1), F.least(F.lit(bins - 1), at)), F.lit(0)).cast("int")

    rows = known.select(
        span.alias("span"), F.array(*[place(i, c) for i, c in enumerate(features)]).alias("bins"),
        F.floor((value(response) - F.lit(low)) / F.lit(step) + 0.5).cast("long").alias("y"))
    return Folds(written(rows, "binned"), folds, step, low, len(features))


def _matrix(batch) -> np.ndarray:
    column = batch.column("bins")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def train(data: Folds, trees: int, depth: int, rate: float, bins: int = BINS, min_leaf: int = MIN_LEAF):
    """(base, trees) for each fold; fold f learns from the spans up to f.

    All folds grow side by side, level by level. A level is one pass: each task sums residuals by fold, node, feature and bin,
    and the driver receives these sums, at most ``folds * 2 ** depth * features * bins`` of them.
    """
    k, folds, spark = data.features, data.count, data.rows.sparkSession
    spans = {r["span"]: (r["n"], r["s"]) for r in data.rows.groupBy("span").agg(F.count("*").alias("n"), F.sum("y").alias("s")).collect()}
    models = []
    for f in range(folds):
        n, s = (sum(spans.get(i, (0, 0))[j] for i in range(f + 1)) for j in (0, 1))
        models.append((round(s / n) if n else 0, []))
    names = ("fold", "node", "feature", "bin", "n", "s")
    schema = pa.schema([(c, pa.int64()) for c in names])

    def totals(level: int, growing: list[Tree]):
        nodes = 1 << level
        sent = spark.sparkContext.broadcast((models, growing))

        def add(batches):
            known, partial = sent.value
            counts = np.zeros((folds, nodes * k * bins), np.int64)
            sums = np.zeros_like(counts)
            for batch in batches:
                span, y, matrix = batch.column("span").to_numpy(), batch.column("y").to_numpy(), _matrix(batch)
                for f, (base, grown) in enumerate(known):
                    used = span <= f
                    if used.any():
                        own = matrix[used]
                        rest = (y[used] - predict(base, grown, own, depth)).astype(float)
                        cell = ((descend(partial[f], own, level)[:, None] * k + np.arange(k)) * bins + own).ravel()
                        counts[f] += np.bincount(cell, minlength=counts.shape[1])
                        # sums of a batch stay whole as doubles: fewer than 2 ** 53 steps
                        sums[f] += np.bincount(cell, np.repeat(rest, k), counts.shape[1]).astype(np.int64)
            fold, cell = np.nonzero(counts)
            node, place = np.divmod(cell, k * bins)
            feature, at = np.divmod(place, bins)
            columns = (fold, node, feature, at, counts[fold, cell], sums[fold, cell])
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=schema)

        found = data.rows.mapInArrow(add, ", ".join(f"{c} long" for c in names)).groupBy(*names[:4]).agg(
            F.sum("n").alias("n"), F.sum("s").alias("s")).toPandas()
        sent.unpersist()
        counts = np.zeros((folds, nodes, k, bins), np.int64)
        sums = np.zeros_like(counts)
        at = tuple(found[c].to_numpy() for c in names[:4])
        counts[at], sums[at] = found["n"], found["s"]
        return counts, sums

    for _ in range(trees):
        inner = (1 << depth) - 1
        growing = [Tree(np.full(inner, -1), np.zeros(inner, np.int64), np.zeros(1 << depth, np.int64)) for _ in models]
        for level in range(depth):
            counts, sums = totals(level, growing)
            for f, tree in enumerate(growing):
                for node in range(1 << level):
                    found = best_split(counts[f, node], sums[f, node], min_leaf)
                    place = (1 << level) - 1 + node
                    if found is not None:
                        tree.feature[place], tree.cut[place] = found
                    if level == depth - 1:  # the lowest row follows from the sums on both sides of the last cut
                        cut = found[1] + 1 if found else bins
                        feature = found[0] if found else 0
                        for side, part in enumerate((slice(0, cut), slice(cut, bins))):
                            n, s = int(counts[f, node, feature, part].sum()), int(sums[f, node, feature, part].sum())
                            tree.leaf[2 * node + side] = round(rate * s / n) if n else 0
        for (_, grown), tree in zip(models, growing):
            grown.append(tree)
    return models



def boosted_folds(
    df: DataFrame, response: str, features, ts: str = "date", folds: int = 4, trees: int = 10, depth: int = 3, rate: float = 0.3,
    bins: int = BINS, min_leaf: int = MIN_LEAF,
) -> DataFrame:
    """fold, train_rows, test_rows, rmse, mae, r2, mean_rmse: boosted trees on folds that only look back.

    Fold f (from 1) learns from the first f of ``folds + 1`` equal spans of time and is judged on the next. ``mean_rmse`` is the
    error of the training mean, for comparison; r2 compares with the mean of the judged rows. Metrics of a fold without
    rows to judge are null. Rows without response or time are left out. An empty table has folds of no rows.

    Trees are the same at any partitioning: features are bins and responses whole steps (:func:`binned`), so sums are exact.
    """
    features = list(features)
    if not features or folds < 1 or trees < 1 or depth < 1:
        raise ValueError("features, folds, trees and levels are needed")
    data = binned(df, response, features, ts, folds, bins)
    models = train(data, trees, depth, rate, bins, min_leaf)
    sent = df.sparkSession.sparkContext.broadcast(models)
    names = ("fold", "train_rows", "n", "squares", "absolute", "base_squares", "sum", "sum_squares")
    schema = pa.schema([(c, pa.int64() if c in names[:3] else pa.float64()) for c in names])

    def judge(batches):
        total = np.zeros((folds, len(names) - 1))
        for batch in batches:
            span, y, matrix = batch.column("span").to_numpy(), batch.column("y").to_numpy(), _matrix(batch)
            for f, (base, grown) in enumerate(sent.value):
                total[f, 0] += (span <= f).sum()
                judged = span == f + 1
                own = y[judged].astype(float)
                miss = own - predict(base, grown, matrix[judged], depth)
                total[f, 1:] += (len(own), miss @ miss, np.abs(miss).sum(), ((own - base) ** 2).sum(), (own - STEPS / 2).sum(),
                                 ((own - STEPS / 2) ** 2).sum())
        columns = [np.arange(folds), *total.T]
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype("int64" if t.type == pa.int64() else "float64"))
                                          for c, t in zip(columns, schema)], schema=schema)

    ddl = ", ".join(f"{c} {'long' if c in names[:3] else 'double'}" for c in names)
    sums = data.rows.mapInArrow(judge, ddl).groupBy("fold").agg(*[F.sum(c).alias(c) for c in names[1:]])
    every = df.sparkSession.range(folds).select(F.col("id").alias("fold"))
    spread = F.col("sum_squares") - F.col("sum") * F.col("sum") / F.col("n")
    have, step = F.col("n") > 0, F.lit(data.step)
    return every.join(sums, "fold", "left").select(
        (F.col("fold") + 1).cast("int").alias("fold"), F.coalesce("train_rows", F.lit(0)).alias("train_rows"),
        F.coalesce("n", F.lit(0)).alias("test_rows"),
        F.when(have, F.sqrt(F.try_divide("squares", "n")) * step).alias("rmse"),
        F.when(have, F.try_divide("absolute", "n") * step).alias("mae"),
        F.when(have & (spread > 0), 1 - F.try_divide(F.col("squares"), spread)).alias("r2"),
        F.when(have, F.sqrt(F.try_divide("base_squares", "n")) * step).alias("mean_rmse"))
