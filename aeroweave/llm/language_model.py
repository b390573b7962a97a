"""LM scoring: token counts of the whole training corpus, a recurrent model trained in parallel, log-probabilities of texts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm import gru
from aeroweave.llm.gam import held_out
from aeroweave.llm.shared import arrow_schema, record_batch, written

#: The most frequent words, so many at most, held by every task with their counts; all others are looked up by a join.
HELD_WORDS = 200_000
_STEPS = 64
#: The corpus is passed over once, in so many parts; workers average after each.
ROUNDS = 2
#: Bytes of text that are split into words at a time.
SLICE_BYTES = 16 * 2**20
#: Words whose numbers a task gathers before the network passes over them.
CHUNK_WORDS = 2_000_000
#: Words of a share, which one worker passes over by itself.
SHARE_WORDS = 5_000_000
_END = b"\n"
_ADD = 0.1
_BLOCK = 4096


class Vocabulary(NamedTuple):
    words: pa.Array  # as bytes, the most frequent first
    counts: np.ndarray
    tokens: int
    kinds: int

    @property
    def all_mass(self) -> float:
        return self.tokens + _ADD * (self.kinds + 1)

    @property
    def rare_mass(self) -> float:
        """The mass of words outside the head, with one kind for all unseen words."""
        head = self.counts[:gru.HEAD]
        return self.tokens - float(head.sum()) + _ADD * (self.kinds - len(head) + 1)


def _slices(parts: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where texts come to SLICE_BYTES; a longer text is a slice of its own."""
    for part in parts:
        ends = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < part.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield part.slice(start, stop - start)
            start = stop


class Words(NamedTuple):
    """Lower-cased words of all texts of a slice, and the text of each; ends are not among them."""

    words: pa.Array
    row: np.ndarray


def words_of(texts: pa.Array) -> Words:
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, ""))))
    words, row = split.flatten().cast(pa.binary()), np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    some = pc.greater(pc.binary_length(words), 0)  # a text without a word splits into an empty one
    return Words(words.filter(some), row[some.to_numpy(zero_copy_only=False)])


def _count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema("word binary, n long")
    for part in _slices(parts, 0):
        found = pc.value_counts(words_of(part.column(0)).words)
        yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], schema=schema)
        yield record_batch([(_END, part.num_rows)], schema)


def count_words(texts: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` of all tokens of the one column of ``texts``, summed per slice first."""
    return texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _head(numbers: np.ndarray) -> np.ndarray:
    return np.where((numbers >= 0) & (numbers < gru.HEAD), numbers, gru.RARE).astype(np.uint16)


_NUMBERED = ("row long, doc_id long, held_out boolean, share int, place long, n_tokens long, n_known long, base double, rare double, "
             "head binary, words array<binary>, times array<int>")


def _lists(rows: int, row: np.ndarray, *columns: pa.Array) -> list[pa.ListArray]:
    """Values dealt to the rows that ``row``, in ascending order, names."""
    offsets = pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, c) for c in columns]


def _numberer(vocabulary):
    """Each text once: what its words known to the task add up to, the numbers of its head words, and its other words."""
    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, schema = vocabulary.value, arrow_schema(_NUMBERED)
        logs = np.append(np.log10((held.counts + _ADD) / held.all_mass), 0.0)  # the last one is for words that aren't held
        rare = logs + np.log10(held.all_mass / held.rare_mass)
        rare[:gru.HEAD], rare[-1] = 0.0, 0.0
        end = pc.index(held.words, pa.scalar(_END, pa.binary())).as_py()
        for part in _slices(parts, 5):
            rows, (words, row) = part.num_rows, words_of(part.column(5))
            n = np.full(len(words) + rows, end, np.int64)
            starts = np.searchsorted(row, np.arange(rows)) + np.arange(rows)  # an end follows each text before
            n[np.arange(len(words)) + row] = pc.fill_null(pc.index_in(words, value_set=held.words), -1).to_numpy(zero_copy_only=False)
            sizes = np.diff(np.append(starts, len(n)))
            other = np.flatnonzero(n < 0)
            of = np.repeat(np.arange(rows), sizes)
            is_end = other == (starts + sizes - 1)[of[other]]
            spelled = pa.concat_arrays([words.take(pa.array(other[~is_end] - of[other[~is_end]])), pa.array([_END] * int(is_end.sum()), pa.binary())])
            table = pa.table({"row": np.concatenate([of[other[~is_end]], of[other[is_end]]]), "word": spelled, "n": np.ones(len(other), np.int32)})
            grouped = table.group_by(["row", "word"]).aggregate([("n", "sum")]).sort_by("row")
            by_row = grouped.column("row").to_numpy()
            lists = _lists(rows, by_row, grouped.column("word").combine_chunks(), grouped.column("n_sum").combine_chunks().cast(pa.int32()))
            heads = pa.Array.from_buffers(pa.binary(), rows, [
                None, pa.py_buffer(np.append(starts, len(n)).astype(np.int32) * 2), pa.py_buffer(_head(n))])
            sums = [np.add.reduceat(v, starts) for v in ((n >= 0).astype(np.int64), logs[n], rare[n])]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in range(5)), pa.array(sizes), *map(pa.array, sums), heads, *lists], schema=schema)
    return number


def _learner(params):
    """A model for each share of texts that a task meets, one after the other, in blocks of parameters."""
    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema("block int, weight double, part array<double>")
        share, trainer, held, size = None, None, [], 0

        def learnt():
            trainer.learn(held)
            values = gru.flat(trainer.params).astype(float)
            return record_batch(
                [(k, float(trainer.tokens), values[k * _BLOCK:(k + 1) * _BLOCK]) for k in range(-(-len(values) // _BLOCK))], schema)

        for part in parts:
            for now, head in zip(part.column(0).to_pylist(), part.column(1)):
                if now != share:
                    if trainer is not None:
                        yield learnt()
                    share, trainer, held, size = now, gru.Trainer(gru.unflat(params.value)), [], 0
                held.append(np.frombuffer(head.as_buffer(), np.uint16).astype(np.int32))
                size += len(held[-1])
                if size > CHUNK_WORDS:
                    trainer.learn(held)
                    held, size = [], 0
        if trainer is not None:
            yield learnt()
    return learn


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    part = np.average(np.stack(rows["part"].to_numpy()), axis=0, weights=rows["weight"])
    return pd.DataFrame({"block": rows["block"].iloc[:1], "part": [part]})


def shares_of(tokens: int) -> int:
    """Shares that each round's texts are dealt to: by the corpus alone, so that results don't depend on the cluster."""
    return max(1, -(-tokens // (ROUNDS * SHARE_WORDS)))


def train(numbered: DataFrame, vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters learnt from all of ``numbered`` (share, place, head): each share is passed over once and the means go on.

    Shares are dealt by a hash of the text, ``rounds`` times as many as a round has; round k takes those of remainder k. Within a
    share texts follow their hash, so neither tasks nor the order of files matter. The parameters of each share (about 140 thousand
    numbers) are averaged in blocks, weighted by tokens.
    """
    spark, held = numbered.sparkSession, vocabulary.value
    values = gru.flat(gru.initial(held.counts[:gru.HEAD], held.rare_mass))
    shares = shares_of(held.tokens)
    for k in range(rounds):
        own = numbered.filter(F.pmod("share", F.lit(rounds)) == k).repartition(shares, "share").sortWithinPartitions("share", "place", "head")
        learn = _learner(spark.sparkContext.broadcast(values))
        parts = own.select("share", "head").mapInArrow(learn, "block int, weight double, part array<double>").groupBy("block").applyInPandas(
            _mean, "block int, part array<double>").collect()
        if parts:
            values = np.concatenate([row.part for row in sorted(parts, key=lambda r: r.block)]).astype(np.float32)
    return values


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"


def _scorer(params):
    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, schema = gru.unflat(params.value), arrow_schema(_SCORED)
        table, heads, out, size = gru.drives(model), [], [], 0

        def finished():
            logs = gru.score(model, heads, table) / np.log(10)
            return record_batch([(*row[:6], row[6] + float(log)) for row, log in zip(out, logs)], schema)

        for part in parts:
            columns = [part.column(c).to_pylist() for c in range(7)]
            for *row, head in zip(*columns, part.column(7)):
                out.append(row)
                heads.append(np.frombuffer(head.as_buffer(), np.uint16).astype(np.int32))
                size += len(heads[-1])
                if size > CHUNK_WORDS:
                    yield finished()
                    heads, out, size = [], [], 0
        if out:
            yield finished()
    return score


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """About the ``most`` most frequent words, never more: found from a histogram in steps of 2 ** (1 / 64).

    Whole steps are taken from the top. Of the first one that does not fit, words are taken by a hash, as many as still do.
    """
    step = F.floor(F.log2("n") * _STEPS).cast("int")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    held = 0
    for row in sizes:
        if held + row.words > most:
            # a little less than the room, so that chance does not exceed it
            share = max(0.0, (most - held - 4 * (most - held) ** 0.5) / row.words)
            hashed = F.pmod(F.xxhash64("word"), F.lit(2**30)) < int(share * 2**30)
            return counts.filter((step > row.step) | ((step == row.step) & hashed))
        held += row.words
    return counts


def score_texts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = 10, held_fold: int = 0,
    rounds: int = ROUNDS, held_words: int = HELD_WORDS,
) -> DataFrame:
    """Log10 probabilities of every whole text under smoothed word counts and under the recurrent model.

    Returns id, held_out, n_tokens, n_known, train_tokens, base_score and score. Both learn from all texts outside the held-out
    fold (a null id is inside none of it and is learnt from). A null or empty text is its end token alone. Repeated rows are learnt from
    and scored as often as they occur, an empty table gives no rows, and texts may be of any length. Words as frequent as the last of the
    held ones are held or not by their hash, and head words of equal counts go by their bytes; either way they are counted exactly.

    The model gives a head word the probability of its class times its own in the class, and every other word the
    probability of the rare class times its smoothed share of the counts outside the head; one kind stands for all unseen
    words, so the probabilities sum to one. Counts of the ``held_words`` most frequent words go to every task; rarer words of a
    text are looked up in the full counts by a join, pre-aggregated per text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"),
        held_out(F.col(id_column), folds, held_fold).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    counts = written(count_words(rows.filter("not held_out").select("text")), "counts")
    tokens, kinds = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = frequent_words(counts, held_words).toPandas().sort_values(["n", "word"], ascending=[False, True])
    words = pa.array([bytes(w) for w in top["word"]], pa.binary())
    vocabulary = spark.sparkContext.broadcast(Vocabulary(words, top["n"].to_numpy(np.float64), tokens, kinds))
    place = F.xxhash64(F.coalesce("text", F.lit("")))
    dealt = rows.select(
        "row", "doc_id", "held_out", F.pmod(place, F.lit(rounds * shares_of(tokens))).cast("int").alias("share"), place.alias("place"), "text")
    numbered = written(dealt.mapInArrow(_numberer(vocabulary), _NUMBERED), "numbered")
    params = spark.sparkContext.broadcast(train(numbered.filter("not held_out"), vocabulary, rounds))
    scored = written(numbered.select(
        "row", "doc_id", "held_out", "n_tokens", "n_known", "base", "rare", "head").mapInArrow(_scorer(params), _SCORED), "scored")
    mass, rare = vocabulary.value.all_mass, vocabulary.value.rare_mass
    others = numbered.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    looked_up = (
        others.join(counts, "word", "left").withColumn("log", F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + _ADD) / mass))
        .groupBy("row").agg(F.sum("log").alias("log"), F.sum("times").alias("times"),
                            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known")))
    add = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(looked_up, "row", "left").select(
        F.col("doc_id").alias(id_column), "held_out", "n_tokens", (F.col("n_known") + add("known")).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + add("log")).alias("base_score"),
        (F.col("model") + add("log") + add("times") * float(np.log10(mass / rare))).alias("score"))
