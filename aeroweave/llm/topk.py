"""Exact top-k search: all scores are counted into histograms, refined per query until the kth value is known."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.llm.shared import arrow_schema, discard, written

#: log2 of the bins a round of histograms has for each query.
BITS = 8
#: Vector components one side of a cell holds at most; with 64 components these are 32,768 vectors.
CELL_NUMBERS = 2**21
#: Candidates are dealt to so many groups at least, so that small tables keep several tasks busy too.
SPREAD = 32
_TILE = (256, 4096)


def usable(vector: str) -> Column:
    """Whether a vector and all of its components are known and finite."""
    known = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(F.col(vector).cast("array<double>"), known), F.lit(False))


class _Side:
    """Rows of a cell as a matrix, short vectors filled up with zeros."""

    def __init__(self, table: pa.Table, width: int, kind: str):
        units = table.column("units").combine_chunks()
        sizes = np.diff(units.offsets.to_numpy())
        matrix = np.zeros((len(units), width), kind)
        matrix[np.arange(width) < sizes[:, None]] = units.flatten().to_numpy()
        self.rows = table.column("row").to_numpy()
        self.matrix = matrix
        self.table = table


def _tiles(queries: _Side, candidates: _Side):
    """Scores of some queries with some candidates, which entry is a row with itself, and whether these are a query's last."""
    deep, broad = _TILE
    _, mine, own = np.intersect1d(queries.rows, candidates.rows, return_indices=True)
    for i in range(0, len(queries.rows), deep):
        for j in range(0, len(candidates.rows), broad):
            scores = queries.matrix[i:i + deep] @ candidates.matrix[j:j + broad].T
            same = (mine >= i) & (mine < i + deep) & (own >= j) & (own < j + broad)
            yield i, j, scores.astype(np.int64, copy=False), (mine[same] - i, own[same] - j), j + broad >= len(candidates.rows)


def _histograms(width: int, kind: str, shift: int):
    """Counts per query and bin of one cell.

    A cell's own kth value is a lower limit of the kth of all, so bins below it are not sent: at most k per query.
    """
    bins = 1 << BITS
    schema = arrow_schema("row long, bin long, n long")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return schema.empty_table()
        candidates, queries = _Side(left, width, kind), _Side(right, width, kind)
        low, need = (right.column(c).to_numpy() for c in ("low", "need"))
        found = []
        counts = None
        for i, j, scores, same, last in _tiles(queries, candidates):
            size = len(scores)
            if j == 0:
                counts = np.zeros(size * bins, np.int64)
            at = (scores - low[i:i + size, None]) >> shift
            at[same] = -1
            inside = (at >= 0) & (at < bins)
            at += (np.arange(size) * bins)[:, None]
            counts += np.bincount(at[inside], minlength=size * bins)
            if last:
                down = counts.reshape(size, bins)[:, ::-1]
                sent = (down > 0) & (down.cumsum(axis=1) - down < need[i:i + size, None])
                which, place = np.nonzero(sent)
                found.append((queries.rows[i + which], bins - 1 - place, down[sent]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], schema=schema)
    return count


def _hits(width: int, kind: str):
    """Scores above a query's kth value, and of those equal to it the smallest ids, as many as it still needs."""
    schema = arrow_schema("row long, query long, candidate long, score long")

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return schema.empty_table()
        left = left.sort_by([("id", "ascending"), ("row", "ascending")])  # unknown ids come last
        candidates, queries = _Side(left, width, kind), _Side(right, width, kind)
        low, need = (right.column(c).to_numpy() for c in ("low", "need"))
        open_ties = need.copy()
        found = []
        for i, j, scores, same, _ in _tiles(queries, candidates):
            kth = low[i:i + len(scores), None]
            over, tied = scores > kth, scores == kth
            over[same] = tied[same] = False
            tied &= tied.cumsum(axis=1) <= open_ties[i:i + len(scores), None]
            open_ties[i:i + len(scores)] -= tied.sum(axis=1)
            which, place = np.nonzero(over | tied)
            found.append((i + which, j + place, scores[which, place]))
        which, place, score = (np.concatenate(c) for c in zip(*found))
        return pa.Table.from_arrays([
            pa.array(queries.rows[which]), right.column("id").combine_chunks().take(pa.array(which)),
            left.column("id").combine_chunks().take(pa.array(place)), pa.array(score)], schema=schema)
    return pick


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The ``k`` candidates of highest score for every query row: query, rank, vec_id and score.

    A vector's components become ``floor(scale * x)`` and a score is their inner product, a whole number. Candidates are
    all rows but the query's own. Equal scores go by the smaller id, unknown ids last. Rows whose vector is null or
    holds a null or a component that is not finite take no part; an empty vector scores 0, and of two vectors of different lengths
    the shorter one counts as filled up with zeros. Repeated rows are rows of their own, as candidates and as queries.
    With fewer than ``k`` candidates all are returned; an empty table gives no rows. Only the two named columns are
    read. Scores that might not fit a long are refused.

    Queries and candidates are dealt to groups of bounded size, and every group of queries meets every group of candidates in
    a cell of its own. Each round counts all scores of a cell into 256 bins per query, sums the counts over cells and
    goes on inside the bin that holds the kth value, until bins are one score wide. A last round takes what lies above, and as
    many ties as are missing. Nothing but counts and these rows is shuffled besides the vectors themselves.
    """
    read = vectors.filter(usable(vector_column)).select(
        F.col(id_column).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.transform(F.col(vector_column).cast("array<double>"), lambda x: x * scale).alias("units"))
    square = F.aggregate("units", F.lit(0.0), lambda a, x: a + F.floor(x).cast("double") * F.floor(x).cast("double"))
    n, asked, width, top = read.agg(
        F.count("*"), F.count_if("is_query"), F.max(F.size("units")), F.max(
            F.when(F.forall("units", lambda x: F.abs(x) < 2.0**62), square).otherwise(float("inf")))).first()
    k, spark = min(k, n - 1), vectors.sparkSession
    if k < 1 or not asked:
        return spark.createDataFrame([], "query long, rank int, vec_id long, score long")
    bound = top * (1 + 1e-9) + 1  # of any score, by Cauchy and Schwarz, and of any part of its sum
    if bound >= 2.0**62:
        raise ValueError("scores of these vectors do not fit a long")
    bound, width = int(bound), max(width, 1)
    kind = "float32" if bound < 2**24 else "float64" if bound < 2**53 else "int64"

    rows = written(read.select(
        F.monotonically_increasing_id().alias("row"), "id", "is_query",
        F.transform("units", lambda x: F.floor(x)).cast("array<int>" if bound < 2**53 else "array<long>").alias("units")), "units")
    held = max(1, CELL_NUMBERS // width)
    right, left = ceil(asked / held), max(ceil(n / held), min(SPREAD, n))
    group = lambda groups: F.pmod(F.xxhash64("row"), F.lit(groups))
    every = lambda groups: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    candidates = rows.select("row", "id", "units", group(left).alias("c"), every(right).alias("q")).groupBy("c", "q")
    asking = rows.filter("is_query").select(*[F.col(c).alias(c) for c in ("row", "id", "units")])  # columns of their own

    def cells(state, function, schema):
        dealt = asking.join(state, "row").select("*", group(right).alias("q"), every(left).alias("c")).groupBy("c", "q")
        return candidates.cogroup(dealt).applyInArrow(function, schema)

    rounds = max(1, ceil((2 * bound + 1).bit_length() / BITS))
    state = written(asking.select("row", F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("need")), "kth")
    down = Window.partitionBy("row").orderBy(F.desc("bin"))
    for shift in range((rounds - 1) * BITS, -1, -BITS):
        counts = cells(state, _histograms(width, kind, shift), "row long, bin long, n long").groupBy("row", "bin").agg(
            F.sum("n").alias("n"))
        reached = counts.withColumn("upto", F.sum("n").over(down)).join(state, "row")
        holds = (F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need"))
        narrower = written(reached.filter(holds).select(
            "row", (F.col("low") + F.col("bin") * (1 << shift)).alias("low"),
            (F.col("need") - F.col("upto") + F.col("n")).alias("need")), "kth")
        discard(state)
        state = narrower
    hits = cells(state, _hits(width, kind), "row long, query long, candidate long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("candidate"))
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query", F.col("rank").cast("int").alias("rank"), F.col("candidate").alias("vec_id"), "score")
