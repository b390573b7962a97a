"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import written

#: Probabilities of all sources together that may be broadcast, 16 MB of them.
BROADCAST_NUMBERS = 2_000_000
#: More passes over the whole corpus than this are refused; a source's own rate has no limit.
MAX_EPOCHS = 10_000.0
#: Mean repetitions from which a table of probabilities holds only the part around the mean.
WHOLE_RATE = 10_000.0
#: Copies of a row that are made at once.
STEP = 10_000
SALTS = 32
SEED = 20240
_NONE = "\x00none"


def uniform(id_column: Column, seed: int, purpose: str) -> Column:
    """A number in (0, 1) fixed by seed, purpose and id: 48 bits of an MD5."""
    text = F.concat(F.lit(f"{purpose}:{seed}:"), F.coalesce(id_column.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def poisson_table(rate: float) -> np.ndarray:
    """P(X <= k) for k = 0, 1, ... until nothing that a 48-bit number can tell is left."""
    top = int(rate + 12 * np.sqrt(rate) + 40)
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, top + 1)))])
    return np.cumsum(np.exp(np.arange(top + 1) * np.log(rate) - rate - logs)) if rate > 0 else np.ones(1)


def poisson_part(rate: float) -> tuple[int, np.ndarray]:
    """The least k with a chance that a 48-bit number can tell, and P(X <= k) from there on as in :func:`poisson_table`."""
    if rate <= WHOLE_RATE:
        return 0, poisson_table(rate)
    spread = int(12 * np.sqrt(rate)) + 40
    mode = int(rate)
    low = mode - spread
    # log of P(k) / P(mode), added up from the mode to both sides; the sum of all is one
    up = np.cumsum(np.log(rate / np.arange(mode + 1, mode + spread + 1)))
    down = np.cumsum(np.log(np.arange(mode, low, -1) / rate))[::-1]
    parts = np.exp(np.concatenate([down, [0.0], up]))
    return low, np.cumsum(parts / parts.sum())


def target_rates(
    docs: DataFrame, weights: Mapping[str | None, float] | None, source_column: str, text_column: str, epochs: float,
) -> DataFrame:
    """``__group``, ``__rate``, ``__low`` and ``__table`` per source: rate = epochs * weight share * all characters / its characters."""
    groups = docs.groupBy(F.coalesce(F.col(source_column).cast("string"), F.lit(_NONE)).alias("__group")).agg(
        F.sum(F.coalesce(F.length(F.col(text_column).cast("string")), F.lit(0))).alias("chars"))
    if weights is None:
        groups = groups.withColumn("weight", F.when(F.col("chars") > 0, 1.0).otherwise(0.0))
    else:
        rows = [(_NONE if k is None else k, float(v)) for k, v in weights.items()]
        given = docs.sparkSession.createDataFrame(rows, "__name string, weight double")
        groups = groups.join(F.broadcast(given), F.col("__group") == F.col("__name"), "left").select(
            "__group", "chars", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    used = F.when(F.col("chars") > 0, F.col("weight")).otherwise(0.0)
    totals = groups.agg(F.sum("chars").alias("all_chars"), F.sum(used).alias("all_weight"))
    rates = groups.crossJoin(F.broadcast(totals)).select("__group", F.when(
        (F.col("chars") > 0) & (F.col("all_weight") > 0),
        epochs * F.col("weight") / F.col("all_weight") * F.col("all_chars") / F.col("chars")).otherwise(0.0).alias("__rate"))

    def tables(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [poisson_part(rate) for rate in part["__rate"]]
            yield part.assign(__low=[low for low, _ in found], __table=[table for _, table in found])

    return rates.mapInPandas(tables, "__group string, __rate double, __low long, __table array<double>")


def mix_sources(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, id_column: str = "doc_id",
    source_column: str = "source", text_column: str = "text", epochs: float = 1.0, seed: int = SEED,
) -> DataFrame:
    """Repeat documents so that sources have the shares of ``weights`` in characters, and shuffle them globally.

    ``weights`` maps sources to weights (None: the null source); without it all sources weigh the same. A source that
    it doesn't name gets 0, so its documents go; this is what the weights say. Of a source with mean repetition ``r``,
    a document gets ``k`` copies, where ``k`` inverts the Poisson distribution of mean ``r`` at a number hashed from seed
    and id: no state, and the same copies at any partitioning. Repeated rows of one id are each copied as often; null ids
    share one number. A source without characters (all texts null or empty) has rate 0.

    All columns are kept; ``__copy`` counts from 1. Rows are dealt to partitions and ordered within them by
    a hash of seed, id, text and copy. A source may be as small as it is: its rate has no limit. A hot source is only summed, never gathered; rates and their
    tables of probabilities are broadcast when their numbers were counted to be few, and otherwise joined over salts. An empty table
    gives no rows. Input columns whose names begin with two underscores and clash are not supported: ``__copy``, ``__group``, ``__u``,
    ``__n``, ``__from``, ``__order``, ``__salt``, ``__rate``, ``__low``, ``__table``.
    """
    if epochs > MAX_EPOCHS:
        raise ValueError(f"the corpus would have to be repeated more than {MAX_EPOCHS:g} times")
    rates = written(target_rates(docs, weights, source_column, text_column, epochs), "rates")
    named = docs.withColumns({
        "__group": F.coalesce(F.col(source_column).cast("string"), F.lit(_NONE)),
        "__u": uniform(F.col(id_column), seed, "copies")})
    numbers = rates.agg(F.sum(F.size("__table") + 8)).first()[0] or 0
    if numbers <= BROADCAST_NUMBERS:
        joined = named.join(F.broadcast(rates), "__group")
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        joined = named.withColumn("__salt", F.pmod(F.xxhash64(id_column, text_column), F.lit(SALTS)).cast("int")).join(
            rates.withColumn("__salt", salts), ["__group", "__salt"])
    copies = (F.col("__low") + F.size(F.filter("__table", lambda p: p < F.col("__u")))).cast("int")
    order = F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column), F.col("__copy"))
    return (
        joined.withColumn("__n", copies).drop("__table", "__low", "__rate", "__u", "__group", "__salt").filter("__n > 0")
        .withColumn("__from", F.explode(F.sequence(F.lit(1), F.col("__n"), F.lit(STEP))))
        .withColumn("__copy", F.explode(F.sequence("__from", F.least(F.col("__n"), F.col("__from") + (STEP - 1)))))
        .drop("__from").withColumn("__order", order)
        .repartition("__order").sortWithinPartitions("__order", "__copy").drop("__order", "__n"))
