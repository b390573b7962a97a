"""Exact substring dedup: maximal repeats from an enhanced suffix array over sampled suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import arrow_schema, discard, record_batch, text_or_empty, written

#: Bytes of a string that counts as a repeat.
LENGTH = 100
#: Bytes of the gram whose hash samples positions; every LENGTH-byte string holds LENGTH - GRAM + 1 grams and a sampled one.
GRAM = 32
REACH = LENGTH - GRAM
#: Occurrences of one gram that a task holds as a suffix array; more are compared string by string over all tasks.
ARRAY_ROWS = 20_000
#: The group number of copies of a context within their document; its first occurrence is in the groups of other numbers.
COPY = -(2**31)
_CHUNK = 1 << 19
_POSITION = np.uint64(_CHUNK * 2 - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SIGNS = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base, np.uint64), dtype=np.uint64)])


_POWERS: dict[str, np.ndarray] = {}


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every GRAM-byte string of at most _CHUNK + LENGTH bytes."""
    if not _POWERS:
        base = int(_STEP)
        _POWERS["up"], _POWERS["down"] = _powers(base, _CHUNK + LENGTH), _powers(pow(base, -1, 1 << 64), _CHUNK + LENGTH)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_SIGNS[data] * _POWERS["up"][:n], out=sums[1:])
    hashes = (sums[GRAM:] - sums[:-GRAM]) * _POWERS["down"][:n - GRAM + 1]
    hashes ^= hashes >> np.uint64(31)
    hashes *= _STEP
    return hashes ^ (hashes >> np.uint64(29))


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the sampled grams: of each LENGTH-byte string the leftmost gram with the least hash."""
    found_hashes, found_places = [], []
    for start in range(0, max(1, len(data) - LENGTH + 1), _CHUNK):
        part = np.frombuffer(data, np.uint8, min(_CHUNK + LENGTH - 1, len(data) - start), start) if data else np.zeros(0, np.uint8)
        if len(part) < LENGTH:
            continue
        hashes = gram_hashes(part)
        least = (hashes & ~_POSITION) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if rest := REACH + 1 - width:
            least = np.minimum(least[:-rest], least[rest:])
        places = (least & _POSITION).astype(np.int64)
        places = places[np.r_[True, places[1:] != places[:-1]]]
        found_hashes.append(hashes[places])
        found_places.append(places + start)
    if not found_hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, places = np.concatenate(found_hashes), np.concatenate(found_places)
    fresh = np.r_[True, places[1:] != places[:-1]]
    return hashes[fresh], places[fresh]


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def prefix_intervals(lengths: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(first, last, depth, depth of the parent) of the intervals of a sorted list of strings that share a prefix.

    ``lengths[i]`` is the common prefix of strings i and i + 1. A stack holds the open intervals; the parent
    depth of the outermost is -1.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lengths, -1]):
        first = i
        while stack and stack[-1][1] > depth:
            first, inner = stack.pop()
            yield first, i, inner, max(depth, stack[-1][1] if stack else -1)
        if depth >= 0 and (not stack or stack[-1][1] < depth):
            stack.append((first, depth))


def maximal_repeats(rows: list[tuple]) -> Iterator[tuple[int, list[int], int, int]]:
    """(number, members, least offset, greatest offset) of the repeats among different contexts of one gram.

    ``rows`` are (right context, reversed left context) in this order, sorted and distinct. A repeat at offset o is the
    LENGTH-byte string of o bytes left of the gram and the rest from the gram on. An interval of the suffix array shares its
    right side; if its left contexts differ within the offsets it stands for, it is split by an interval scan
    over the sorted left contexts, else all its members share all of them.
    """
    number = 0
    rights = [common_prefix(a[0], b[0]) for a, b in zip(rows, rows[1:])]
    for first, last, depth, outer in prefix_intervals(rights):
        low, high = LENGTH - min(depth, LENGTH), min(REACH, LENGTH - 1 - max(outer, GRAM - 1))
        if low > high:
            continue
        members = sorted(range(first, last + 1), key=lambda i: rows[i][1])
        lefts = [common_prefix(rows[a][1], rows[b][1]) for a, b in zip(members, members[1:])]
        if min(lefts) >= high:  # not left-diverse
            number += 1
            yield number, members, low, high
            continue
        for begin, end, reach, parent in prefix_intervals(lefts):
            least, most = max(low, parent + 1), min(high, reach)
            if least <= most:
                number += 1
                yield number, members[begin:end + 1], least, most


_ANCHORS = "doc long, gram long, place int"
_CONTEXTS = "gram long, right binary, left binary, doc long, place int, stop int, hot boolean"
_REPEATS = "gram long, number int, doc long, start int, stop int, first boolean"
#: Rows with a context are the first of a task, still to be compared with those of other tasks.
_SCANNED = f"{_REPEATS}, right binary, left binary"


def _emit_anchors(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_ANCHORS)
    for part in parts:
        docs, grams, places, held = [], [], [], 0
        for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            hashes, at = anchors(text.encode("utf-8", "surrogatepass"))
            docs.append(np.full(len(at), doc, np.int64)), grams.append(hashes.view(np.int64)), places.append(at.astype(np.int32))
            held += len(at)
            if held > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (docs, grams, places)], schema=schema)
                docs, grams, places, held = [], [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (docs, grams, places)], schema=schema)


def _emit_contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each different context of a gram in a document. A later occurrence of the same context in the document is known
    to be a copy: its row has no context, but where the copied bytes start and stop. Periodic texts are full of these.
    """
    schema, unpack = arrow_schema(_CONTEXTS), zstandard.ZstdDecompressor().decompress
    for part in parts:
        rows = []
        for doc, packed, grams, places, hots in zip(*(part.column(i).to_pylist() for i in range(5))):
            data = unpack(packed)
            seen = set()
            for at, gram, hot in sorted(zip(places, grams, hots)):
                right, left = data[at:at + LENGTH], data[max(0, at - REACH):at][::-1]
                if (gram, right, left) not in seen:
                    seen.add((gram, right, left))
                    rows.append((gram, right, left, doc, at, None, hot))
                elif len(right) + len(left) >= LENGTH:
                    rows.append((gram, None, None, doc, at - len(left), at + len(right), hot))
            if len(rows) > 50_000:
                yield record_batch(rows, schema)
                rows = []
        if rows:
            yield record_batch(rows, schema)


def _group_repeats(gram: int, rows: list[tuple]) -> Iterator[tuple]:
    """Repeats of one gram; ``rows`` are (right, left, doc, place) in this order, sorted."""
    contexts, places = [], []
    for right, left, doc, place in rows:
        if contexts and contexts[-1] == (right, left):
            places[-1].append((doc, place))
        else:
            contexts.append((right, left))
            places.append([(doc, place)])
    for k, ((right, left), held) in enumerate(zip(contexts, places)):
        if len(held) > 1 and len(right) + len(left) >= LENGTH:
            for i, (doc, place) in enumerate(held):
                yield gram, -1 - k, doc, place - len(left), place + len(right), i == 0
    if len(contexts) > 1:
        for number, members, low, high in maximal_repeats(contexts):
            least = min(members, key=lambda m: places[m][0])
            for member in members:
                doc, place = places[member][0]
                yield gram, number, doc, place - high, place - low + LENGTH, member == least


def _scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come with the contexts of a gram together, sorted by right and left context.

    Those of a frequent gram are anywhere: of equal ones in this task all but the first are known to be copies.
    """
    schema, out, now, held, last = arrow_schema(_SCANNED), [], None, [], None
    for part in parts:
        for gram, right, left, doc, place, stop, hot in zip(*(part.column(i).to_pylist() for i in range(7))):
            if right is None:
                out.append((gram, COPY, doc, place, stop, False, None, None))
            elif hot:
                if len(right) + len(left) >= LENGTH:
                    start, end = place - len(left), place + len(right)
                    if (gram, right, left) == last:
                        out.append((gram, COPY, doc, start, end, False, None, None))
                    else:
                        last = gram, right, left
                        out.append((gram, 0, doc, start, end, None, right, left))
            else:
                if gram != now and held:
                    out.extend((*row, None, None) for row in _group_repeats(now, held))
                    held = []
                now = gram
                held.append((right, left, doc, place))
            if len(out) > 50_000:
                yield record_batch(out, schema)
                out = []
    if held:
        out.extend((*row, None, None) for row in _group_repeats(now, held))
    if out:
        yield record_batch(out, schema)


def _strings(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each LENGTH-byte string of a context: (gram, hash of the string, doc, start)."""
    schema = arrow_schema("gram long, string long, doc long, start int")
    for part in parts:
        rows = []
        for gram, right, left, doc, start in zip(*(part.column(i).to_pylist() for i in range(5))):
            data = left[::-1] + right
            for i in range(len(data) - LENGTH + 1):
                value = xxhash.xxh3_64_intdigest(data[i:i + LENGTH])
                rows.append((gram, value - (1 << 64) if value >> 63 else value, doc, start + i))
            if len(rows) > 50_000:
                yield record_batch(rows, schema)
                rows = []
        if rows:
            yield record_batch(rows, schema)


_PACKED = "doc long, id long, packed binary"


def _pack(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, pack = arrow_schema(_PACKED), zstandard.ZstdCompressor(level=1).compress
    for part in parts:
        packed = [pack(text.encode("utf-8", "surrogatepass")) for text in part.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())], schema=schema)


def _packed(numbered: DataFrame) -> DataFrame:
    """Texts are compressed before they are shuffled."""
    return numbered.select("doc", "id", "text").mapInArrow(_pack, _PACKED)


#: Spark deletes the shuffle files of a query when it ends, not when the driver collects its garbage, and packs tables tighter.
_SPARING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


def _step(df: DataFrame, label: str) -> DataFrame:
    """``df`` written; the shuffle files it took, which nothing reads again, go at once, so that steps don't add up on disk."""
    conf = df.sparkSession.conf
    before = {name: conf.get(name, None) for name in _SPARING}
    try:
        for name, value in _SPARING.items():
            conf.set(name, value)
        return written(df, label)
    finally:
        for name, value in before.items():
            conf.set(name, value) if value is not None else conf.unset(name)


def find_repeats(numbered: DataFrame, array_rows: int = ARRAY_ROWS) -> DataFrame:
    """Maximal repeat groups with all occurrences among the texts of ``numbered`` (``doc``, ``text``).

    Rows are (gram, number, doc, start, stop, first): occurrences of a group share gram and number, all LENGTH-byte strings
    between start and stop are shared, and ``first`` marks the earliest. Long repeats come as a chain of groups, one for
    each sampled gram inside, which is all that reaches REACH bytes left and LENGTH bytes right of it. Copies of a whole context
    that are known from their document, or for a frequent gram from their task, have the number COPY.

    Only grams that occur twice go on from the sampling, with their contexts. These are written where texts and grams meet and shuffled in
    a step of their own, so that the disk holds one step's shuffles at a time. A gram of at most ``array_rows`` occurrences
    is a suffix array in one task: sorted by Spark, scanned as a stream. Contexts of more frequent grams are dealt to all tasks; each keeps the first of equal ones. These are then compared between tasks, and their strings are
    grouped by hash.
    """
    sampled = numbered.select("doc", "text").mapInArrow(_emit_anchors, _ANCHORS)
    counts = _step(sampled.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "grams")
    told = counts.select("gram", (F.col("n") > array_rows).alias("hot"))
    held = sampled.join(told, "gram").groupBy("doc").agg(F.collect_list(F.struct("gram", "place", "hot")).alias("a"))
    contexts = _step(_packed(numbered).join(held, "doc").select(
        "doc", "packed", F.col("a.gram").alias("grams"), F.col("a.place").alias("places"), F.col("a.hot").alias("hots")
    ).mapInArrow(_emit_contexts, _CONTEXTS), "contexts")
    scanned = _step(_scanned(contexts), "repeats")
    discard(contexts)
    found = scanned.filter("right is null").drop("right", "left")
    if told.filter("hot").isEmpty():
        return found
    hot = scanned.filter("right is not null").withColumn("context", F.xxhash64("right", "left"))
    firsts = hot.groupBy("gram", "context").agg(F.min(F.struct("doc", "start", "right", "left")).alias("f"))
    copies = hot.drop("first", "right", "left").join(
        firsts.select("gram", "context", F.col("f.doc").alias("d"), F.col("f.start").alias("s")), ["gram", "context"])
    whole = copies.select("gram", "number", "doc", "start", "stop", ((F.col("doc") == F.col("d")) & (F.col("start") == F.col("s"))).alias("first"))
    strings = firsts.select("gram", "f.right", "f.left", "f.doc", "f.start").mapInArrow(
        _strings, "gram long, string long, doc long, start int")
    earliest = strings.groupBy("gram", "string").agg(F.min(F.struct("doc", "start")).alias("e"), F.count("*").alias("n")).filter("n > 1")
    single = strings.join(earliest, ["gram", "string"]).select(
        "gram", F.lit(0).alias("number"), "doc", "start", (F.col("start") + LENGTH).alias("stop"),
        (F.struct("doc", "start") == F.col("e")).alias("first"))
    return found.unionByName(whole).unionByName(single)


def _scanned(contexts: DataFrame) -> DataFrame:
    """Contexts of a gram meet in one task; copies, which need no comparison, and those of frequent grams go anywhere."""
    spread = F.when(F.col("right").isNull() | F.col("hot"), F.xxhash64("doc", "place"))
    return (contexts.repartition("gram", spread).sortWithinPartitions("gram", "right", "left", "doc", "place")
            .mapInArrow(_scan, _SCANNED))


def _cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """``data`` without the spans, and how many runs they make."""
    pieces, end, runs = [], 0, 0
    for start, stop in sorted(spans):
        if start > end or not runs:
            pieces.append(data[end:start])
            runs += 1
        end = max(end, stop)
    pieces.append(data[end:])
    return b"".join(pieces), runs


_RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _apply(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, unpack = arrow_schema(_RESULT), zstandard.ZstdDecompressor().decompress
    for part in parts:
        rows = []
        for doc_id, packed, starts, stops in zip(*(part.column(i).to_pylist() for i in range(4))):
            data = unpack(packed)
            kept, runs = _cut(data, list(zip(starts or (), stops or ())))
            rows.append((doc_id, len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
        yield record_batch(rows, schema)


def number_documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``doc``, ``text`` and the id: ``doc`` is the id where ids are unique and known, else a number in the order of id and text.

    Equal rows (same id and text) share a number and count as one document; null ids come last.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_or_empty(text_column).alias("text"))
    copies = rows.groupBy("id").agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col("id").isNull())
    if copies.isEmpty():
        return rows.withColumn("doc", F.col("id"))
    keyed = rows.withColumn("key", F.sha2("text", 256))
    order = keyed.select("id", "key").distinct().orderBy(F.col("id").asc_nulls_last(), "key")
    numbers = order.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])).toDF("number_id long, number_key string, doc long")
    return keyed.join(numbers, F.col("id").eqNullSafe(F.col("number_id")) & (F.col("key") == F.col("number_key"))).select("id", "text", "doc", "key")


def dedup_substrings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", array_rows: int = ARRAY_ROWS) -> DataFrame:
    """Every document without the bytes of LENGTH-byte strings that start earlier too.

    Returns id, n_bytes, n_removed, n_spans (runs removed), kept_sha256 and the remaining bytes ``kept`` for every row. Texts are
    UTF-8 bytes, null is empty; strings are judged on the input. Earlier means a smaller id, or the same document and
    an earlier start. A text of under LENGTH bytes has nothing to remove. Null and repeated ids: see :func:`number_documents`.
    Equal texts are repeats of each other, the first one stays whole. Texts may be of any length; an empty table gives no rows.
    """
    numbered = number_documents(docs, id_column, text_column)
    once = numbered.dropDuplicates(["doc"]) if "key" in numbered.columns else numbered
    spans = find_repeats(once, array_rows).filter("not first").select("doc", "start", "stop")
    per_doc = spans.groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("s"))
    return _packed(numbered).join(per_doc, "doc", "left").select(
        "id", "packed", F.col("s.start").alias("starts"), F.col("s.stop").alias("stops")
    ).mapInArrow(_apply, _RESULT).withColumnRenamed("id", id_column)
