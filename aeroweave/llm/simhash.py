"""SimHash near-dedup: pigeonring candidates among distinct fingerprints, then linked groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.components import components
from aeroweave.llm.shared import arrow_schema, sliced, text_or_empty, written

WORDS = 3
HASH_SEED = 42
BITS = 64
#: Fingerprints that differ in so many bits at most are linked. The way for large buckets holds for 2.
MAX_DISTANCE = 2
#: Segments of the ring of bits.
SEGMENTS = 9
_SCHEMA = "id long, text_key long, fingerprint long"
_LAST = 2**63 - 1


def fingerprint(text: str, width: int = WORDS) -> int:
    """Bits set in over half of the XXH64 hashes of the shingles of ``width`` words; 0 without a word."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(HASH_SEED)), "<u8")
    counts = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 15):
        octets = hashes[part:part + (1 << 15)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def fingerprints(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(_SCHEMA)
        for part in sliced(parts):
            found = np.array([fingerprint(text, width) for text in part.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found)], schema=schema)
    return fingerprints


def segment_masks(first: int, length: int, segments: int = SEGMENTS) -> int:
    """The bits of ``length`` consecutive segments on the ring, from segment ``first`` on, as a signed long."""
    mask = 0
    for segment in range(first, first + length):
        k = segment % segments
        for bit in range(BITS * k // segments, BITS * (k + 1) // segments):
            mask |= 1 << bit
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def chain_holds(first: int, difference: Column, max_distance: int = MAX_DISTANCE, segments: int = SEGMENTS) -> Column:
    """Whether the first k segments from ``first`` on differ in at most k * max_distance / segments bits, for every k."""
    holds = F.lit(True)
    for length in range(1, segments + 1):
        budget = length * max_distance // segments
        if length == segments or (length + 1) * max_distance // segments > budget:  # the longest with this budget
            mask = segment_masks(first, length, segments)
            holds = holds & (F.bit_count(difference.bitwiseAND(F.lit(mask))) <= budget)
    return holds


def near_links(prints: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Links ``a``, ``b`` between distinct ``fingerprint`` values that connect exactly those within MAX_DISTANCE bits.

    With ``within``, only fingerprints of equal values of these columns are compared, and links have these columns too.

    If two fingerprints differ in at most d bits, then from some segment of the ring on, every chain of k
    segments differs in at most k * d / SEGMENTS bits. So the first chain whose budget is still below one is equal: it is the
    key of a bucket, one for each start. In a bucket, pairs must hold the whole chain and then the full distance.

    A bucket of so many fingerprints that pairs outnumber one-bit changes of the bits outside its key isn't paired:
    each member is sent to itself and to all these changes, and members that meet anywhere are within two bits.
    Those are stars in place of pairs, and link the same fingerprints.
    """
    equal = (SEGMENTS - 1) // MAX_DISTANCE
    masks = [segment_masks(i, equal) for i in range(SEGMENTS)]
    starts = F.array(*[F.struct(F.lit(i).alias("start"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(masks)])
    keyed = prints.select(*within, "fingerprint", F.explode(starts).alias("s")).select(*within, "fingerprint", "s.start", "s.key")
    free = [[1 << b if b < BITS - 1 else -(1 << b) for b in range(BITS) if not (m >> b) & 1] for m in masks]
    limit = 2 * max(map(len, free))
    sized = keyed.groupBy(*within, "start", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = written(keyed.join(sized, [*within, "start", "key"]), "buckets")

    small = members.filter(F.col("n") <= limit)
    left = small.select(*within, "start", "key", F.col("fingerprint").alias("a"))
    right = small.select(*within, "start", "key", F.col("fingerprint").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    chain = F.lit(False)
    for i in range(SEGMENTS):
        chain = chain | ((F.col("start") == i) & chain_holds(i, difference))
    pairs = left.join(right, [*within, "start", "key"]).filter(F.col("a") < F.col("b")).filter(chain).filter(
        F.bit_count(difference) <= MAX_DISTANCE).select(*within, "a", "b")

    flips = F.element_at(F.array(*[F.array(*[F.lit(v) for v in [0, *row]]) for row in free]), F.col("start") + 1)
    met = members.filter(F.col("n") > limit).select(*within, "start", "fingerprint", F.explode(flips).alias("flip")).select(
        *within, "start", F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("meeting"), "fingerprint")
    centres = met.groupBy(*within, "start", "meeting").agg(F.min("fingerprint").alias("b"), F.count("*").alias("n")).filter("n > 1")
    stars = met.join(centres.drop("n"), [*within, "start", "meeting"]).filter(F.col("fingerprint") != F.col("b")).select(
        *within, F.col("fingerprint").alias("a"), "b")
    return pairs.union(stars).distinct()


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WORDS,
) -> DataFrame:
    """``id``, ``text_key``, ``fingerprint`` and ``component`` (the smallest id reachable over links) of every row.

    A null text counts as empty; texts without a word have fingerprint zero and are linked like any other. Null ids are
    never the smallest unless all are null. Copies share a fingerprint, so only distinct fingerprints are compared. Repeated rows repeat
    their result, an empty table gives no rows, and texts may be of any length. Only the two named columns are read.
    """
    prints = written(docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text_or_empty(text_column)).alias("text_key"),
        text_or_empty(text_column).alias("text")).mapInArrow(_fingerprints(width), _SCHEMA), "fingerprints")
    distinct = prints.groupBy("fingerprint").agg(F.min("id").alias("least"))
    roots = components(near_links(distinct.select("fingerprint")))
    labelled = distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component"))
    groups = written(labelled.join(smallest, "root").select("fingerprint", "component", F.col("root").alias("group")), "groups")
    return prints.join(groups, "fingerprint")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WORDS) -> DataFrame:
    """One row of each group of :func:`near_groups`, all columns as they are: the one with the smallest id.

    Of rows with the smallest id, the one with the least text hash stays; of fully equal (id, text) rows, any one. Null ids come
    last. Texts without a word are one group. An empty table gives no rows. The names ``__id`` and ``__key`` are taken.
    """
    order = F.struct(F.coalesce("id", F.lit(_LAST)).alias("__id"), F.col("text_key").alias("__key"))
    chosen = near_groups(docs, id_column, text_column, width).groupBy("group").agg(F.min(order).alias("first")).select("first.*")
    kept = docs.withColumns({
        "__id": F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)), "__key": F.xxhash64(text_or_empty(text_column))})
    return kept.join(chosen, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"]).drop("__id", "__key")
