"""Quality classifier: a generalised additive model with pairwise interactions, boosted in cycles."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.quality import repeated_words
from aeroweave.llm.shared import arrow_schema, written

#: Labelled rows the model is fitted on at most; of more, those with a small hash of the id.
MAX_ROWS = 100_000
_SHARES = 1 << 30
BINS = 32
PAIR_BINS = 8
PAIRS = 10
ROUNDS = 150
PAIR_ROUNDS = 60
RATE = 0.1
PENALTY = 2.0
THRESHOLD = 0.7
FEATURES = (
    "log_chars log_words mean_word long_words distinct_words top_word repeated_grams repeated_lines log_lines words_per_line "
    "upper digits symbols marks exclaims bars stops commas letters one_word_lines alternation non_ascii vowels").split()
_SCHEMA = "doc_id long, values array<double>"
_VOWELS = frozenset("aeiouyáéíóúàèùâêîôûäöüAEIOUY")


def text_features(text: str) -> list[float]:
    """The inputs of the score, all from the text; shares of an empty text are 0."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    signs = Counter(text)
    count = lambda wanted: sum(signs.get(c, 0) for c in wanted)
    lines = [line for line in text.split("\n") if line.strip()]
    kinds = Counter(words)
    letters = sum(v for c, v in signs.items() if c.isalpha())
    upper = sum(v for c, v in signs.items() if c.isupper())
    return [
        np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / n, sum(len(w) > 12 for w in words) / n,
        len(kinds) / n, max(kinds.values(), default=0) / n, repeated_words(words) / n,
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(len(lines)), len(words) / max(1, len(lines)),
        upper / max(1, letters), sum(v for c, v in signs.items() if c.isdigit()) / chars, count("#*$%&<>@^~") / chars,
        sum(v for c, v in signs.items() if not c.isalnum() and not c.isspace()) / chars, count("!?") / n, count("|") / n,
        count(".") / n, count(",;:") / n, letters / chars, sum(len(x.split()) == 1 for x in lines) / max(1, len(lines)),
        sum(a == b for a, b in zip(words, words[1:])) / n, sum(v for c, v in signs.items() if ord(c) > 127) / chars,
        sum(v for c, v in signs.items() if c in _VOWELS) / max(1, letters),
    ]


def _features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_SCHEMA)
    for part in parts:
        values = [text_features(text or "") for text in part.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, schema.field(1).type)], schema=schema)


class Model(NamedTuple):
    """Lookup tables: ``edges`` and ``tables`` per feature, and for each pair of features its edges and a square table."""

    start: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, values: np.ndarray) -> np.ndarray:
        """Probability of label 1: one table entry per feature and pair is added."""
        total = np.full(len(values), self.start)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, values[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            first = np.searchsorted(self.pair_edges[a], values[:, a], "right")
            total += table[first, np.searchsorted(self.pair_edges[b], values[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _best_cut(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, int]:
    """The cut of ordered bins (last axis) with the greatest gain, and that gain."""
    left_g, left_w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    if not len(left_g):
        return 0.0, 0
    all_g, all_w = gradient.sum(), weight.sum()
    gain = left_g**2 / (left_w + PENALTY) + (all_g - left_g) ** 2 / (all_w - left_w + PENALTY)
    k = int(gain.argmax())
    return float(gain[k] - all_g**2 / (all_w + PENALTY)), k + 1


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Steps of a tree of at most four leaves over ordered bins."""
    step = np.zeros(len(gradient))
    _, middle = _best_cut(gradient, weight)
    for begin, end in ((0, middle), (middle, len(gradient))):
        _, cut = _best_cut(gradient[begin:end], weight[begin:end])
        for low, high in ((begin, begin + cut), (begin + cut, end)):
            if high > low:
                step[low:high] = gradient[low:high].sum() / (weight[low:high].sum() + PENALTY)
    return step


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best cut of both axes of a square of bins: its gain, and the steps of its four parts."""
    g = gradient.cumsum(0).cumsum(1)
    w = weight.cumsum(0).cumsum(1)
    gain, parts = 0.0, []
    for sums in (g, w):
        low = sums[:-1, :-1]
        right, below, both = sums[:-1, -1:] - low, sums[-1:, :-1] - low, sums[-1, -1] - sums[:-1, -1:] - sums[-1:, :-1] + low
        parts.append((low, right, below, both))
    if not parts[0][0].size:
        return 0.0, np.zeros_like(gradient)
    gain = sum(a**2 / (b + PENALTY) for a, b in zip(*parts))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    steps = [a[i, j] / (b[i, j] + PENALTY) for a, b in zip(*parts)]
    step = np.empty_like(gradient)
    step[:i + 1, :j + 1], step[:i + 1, j + 1:], step[i + 1:, :j + 1], step[i + 1:, j + 1:] = steps
    return float(gain[i, j]), step


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """Boost shallow trees of one feature after another, in cycles, then of the pairs that explain most of the rest.

    Without both labels the score is constant (their share, or a half without rows).
    """
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    start = float(np.log(share / (1 - share)))
    n = values.shape[1]
    if len(labels) == 0 or labels.min() == labels.max():
        none = [np.zeros(0)] * n
        return Model(start, none, [np.zeros(1)] * n, [], none, [])
    edges = [_edges(values[:, j], BINS) for j in range(n)]
    bins = [np.searchsorted(edges[j], values[:, j], "right") for j in range(n)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(labels), start)

    def sums(index, size):
        p = 1 / (1 + np.exp(-total))
        return np.bincount(index, labels - p, size), np.bincount(index, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j in range(n):
            step = RATE * _tree(*sums(bins[j], len(tables[j])))
            tables[j] += step
            total += step[bins[j]]
    pair_edges = [_edges(values[:, j], PAIR_BINS) for j in range(n)]
    coarse = [np.searchsorted(pair_edges[j], values[:, j], "right") for j in range(n)]
    sizes = [len(e) + 1 for e in pair_edges]

    def square(a, b):
        return [x.reshape(sizes[a], sizes[b]) for x in sums(coarse[a] * sizes[b] + coarse[b], sizes[a] * sizes[b])]

    ranked = sorted(((_quadrants(*square(a, b))[0], a, b) for a in range(n) for b in range(a + 1, n)), reverse=True)
    pairs = [(a, b) for gain, a, b in ranked[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in zip(pairs, pair_tables):
            step = RATE * _quadrants(*square(a, b))[1]
            table += step
            total += step[coarse[a], coarse[b]]
    return Model(start, edges, tables, pairs, pair_edges, pair_tables)


def _score(model):
    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("doc_id long, score double")
        for part in parts:
            values = np.array(part.column(1).to_pylist(), float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.value.score(values))], schema=schema)
    return score


def held_out(column, parts: int, remainder: int):
    """Whether crc32 of the id as text leaves ``remainder``; false for a null id."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts == remainder, F.lit(False))


def score_quality(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", folds: int = 4, held_fold: int = 2, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """A quality score between 0 and 1 for every row of ``docs``, learnt from labels outside the held-out fold.

    Returns id, held_out, score and predicted (1 from THRESHOLD on). Features come from the whole text alone; they are
    written once to the shared folder, and learning and scoring read them there. The fit sees at most ``max_rows`` labelled
    rows on the driver (those with a small hash of the id, a bounded matrix), scoring adds table entries
    per batch. Null texts count as empty; rows with a null id are scored but not learnt from; of several labels of an id the
    mean counts; null labels are none. Without labels every score is 0.5. Repeated rows and equal texts get equal scores; an empty table
    gives no rows.
    """
    features = written(docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("t")).mapInArrow(_features, _SCHEMA), "features")
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("double").alias("label")).dropna()
    known = known.filter(~held_out(F.col("doc_id"), folds, held_fold)).groupBy("doc_id").agg(F.avg("label").alias("label"))
    # a share of the hashes that holds max_rows ids less six standard deviations, so that no task sends more than its part
    share = (max_rows - min(6 * max_rows**0.5, max_rows / 2)) / max(1, known.count())
    low = F.pmod(F.xxhash64("doc_id"), F.lit(_SHARES)) < int(min(1.0, share) * _SHARES)
    rows = features.join(known.filter(low), "doc_id").select("doc_id", "values", "label").toPandas()
    rows = rows.iloc[np.lexsort([rows["label"], rows["doc_id"]])][:max_rows]  # learnt from in one order
    values = np.array(rows["values"].tolist(), float).reshape(-1, len(FEATURES))
    model = docs.sparkSession.sparkContext.broadcast(fit(values, rows["label"].to_numpy(float)))
    scored = features.mapInArrow(_score(model), "doc_id long, score double")
    return scored.select(
        F.col("doc_id").alias(id_column), held_out(F.col("doc_id"), folds, held_fold).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
