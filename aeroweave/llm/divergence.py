"""Source divergence audit: word-start pointers sorted by multikey quicksort, whose equal runs count terms per source."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroweave.llm.shared import arrow_schema, broadcast_if_small, discard, text_or_empty, written

#: A term must be in so many documents of its language.
MIN_DOCS = 30
#: Added to every count before shares are formed.
SMOOTHING = 5
#: Terms listed per group.
LISTED = 50
#: Bytes of text whose pointers are sorted together; a longer text is sorted alone.
SLICE_BYTES = 4 * 2**20
#: Terms and sources on one side of a block of the pairwise sums.
BLOCK_TERMS, BLOCK_SOURCES = 256, 256
_UNIT = 1_000_000_000

# Terms are runs of these bytes; no byte of a character beyond ASCII is below 0x80.
_IN_TERM = np.ones(256, bool)
_IN_TERM[0x00:0x41] = _IN_TERM[0x5B:0x61] = _IN_TERM[0x7B:0x80] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def term_pointers(data: np.ndarray, offsets: np.ndarray):
    """Start, length and document of every term in ``data``, whose documents begin at ``offsets`` (its end included)."""
    inside = _IN_TERM[data]
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    before[borders] = False
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    return starts, lengths, np.searchsorted(offsets, starts, "right") - 1


def sort_pointers(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Order of the terms and a mark where a new term begins, by multikey quicksort with eight bytes as one character.

    Pointers are split by the first eight bytes of their terms; within every part of more than one pointer the next eight
    decide, and so on. A term has no zero byte, so what is beyond its end sorts first. Equal terms stay in the order given.
    """
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))  # the eight bytes from each place on
    left = np.minimum(np.arange(9), 8)
    masks = np.array([0 if n == 0 else (2**64 - 1) << (64 - 8 * int(n)) & (2**64 - 1) for n in left], np.uint64)

    def character(pointers, depth):
        rest = np.clip(lengths[pointers] - depth, 0, 8)
        return eight[np.minimum(starts[pointers] + depth, len(data))].astype(np.uint64) & masks[rest]

    keys = character(np.arange(len(starts)), 0)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, bool)
    places, depth = np.arange(len(order)), 0
    while True:
        part = np.cumsum(new)[places]
        shared = np.bincount(part, minlength=part[-1] + 1)[part] > 1 if len(part) else np.zeros(0, bool)
        longer = shared & ((keys & np.uint64(0xFF)) != 0)
        places, part, depth = places[longer], part[longer], depth + 8
        if not len(places):
            return order, new
        pointers = order[places]
        keys = character(pointers, depth)
        within = np.lexsort((keys, part))
        order[places], keys = pointers[within], keys[within]
        # parts keep their places; only borders inside of them are new
        new[places[1:]] |= (keys[1:] != keys[:-1]) & (part[1:] == part[:-1])


def equal_runs(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray):
    """Per term and group of documents: the term's bytes and their ends, group, occurrences, and documents with the term.

    Documents of a group follow each other.
    """
    starts, lengths, docs = term_pointers(data, offsets)
    lowered = _LOWER[data]
    order, new = sort_pointers(lowered, starts, lengths)
    group, doc = groups[docs][order], docs[order]
    changed = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else new
    run = new.copy()
    run[1:] |= group[1:] != group[:-1]
    firsts = np.flatnonzero(run)
    times = np.diff(np.append(firsts, len(order)))
    documents = np.add.reduceat((new | changed).astype(np.int64), firsts) if len(firsts) else times
    heads, sizes = starts[order[firsts]], lengths[order[firsts]]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    bytes_of = np.repeat(heads - ends[:-1], sizes) + np.arange(ends[-1])
    return lowered[bytes_of], ends, group[firsts], times, documents


def _slices(sizes: np.ndarray):
    """Ranges of documents of at most SLICE_BYTES together, or a single one."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > SLICE_BYTES:
            yield begin, i
            begin, held = i, 0
        held += int(size)
    if len(sizes):
        yield begin, len(sizes)


def _count(batches):
    schema = arrow_schema("lang string, source string, term string, n long, docs long")
    for batch in batches:
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        by_group = np.argsort(group, kind="stable")
        text = batch.column("text").cast(pa.large_binary())
        sizes = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1])
        for begin, end in _slices(sizes[by_group]):
            chosen = by_group[begin:end]
            part = text.take(pa.array(chosen))
            offsets = np.frombuffer(part.buffers()[1], np.int64)[:len(part) + 1]
            data = np.frombuffer(part.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
            terms, ends, groups, times, documents = equal_runs(data, offsets - offsets[0], group[chosen])
            term = pa.StringArray.from_buffers(len(times), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(terms))
            where = np.divmod(groups, len(source.dictionary))
            yield pa.RecordBatch.from_arrays([
                lang.dictionary.take(pa.array(where[0])), source.dictionary.take(pa.array(where[1])), term,
                pa.array(times.astype(np.int64)), pa.array(documents.astype(np.int64))], schema=schema)


def count_terms(docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source") -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents with the term); nulls count as empty strings."""
    read = docs.select(*[text_or_empty(c).alias(name) for c, name in (
        (text_column, "text"), (lang_column, "lang"), (source_column, "source"))])
    counted = read.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(10^9 (count + 5) / (total + 5 terms))``, in whole numbers."""
    wide = lambda c: c.cast("decimal(19,0)")
    up = F.lit(_UNIT).cast("decimal(10,0)") * wide(count + SMOOTHING)
    return 1 + F.call_function("div", up, wide(total + SMOOTHING * terms))


def _distances(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of differences over the terms that occur in either block of sources, for each pair of a source of one with one of the other."""
    schema = arrow_schema("lang string, source string, other string, sum long, terms long")
    if not (left.num_rows and right.num_rows):
        return schema.empty_table()
    terms = pa.concat_tables([left, right]).column("term").combine_chunks().drop_null().unique()
    sides = []
    for table in (left, right):
        names = table.column("source").combine_chunks().dictionary_encode()
        matrix = np.zeros((len(names.dictionary), len(terms)), np.int64)
        indices = names.indices.to_numpy()
        matrix[indices] = table.column("base").to_numpy()[:, None]
        column = pa.compute.index_in(table.column("term").combine_chunks(), terms, skip_nulls=True)
        known = column.is_valid().to_numpy(zero_copy_only=False)
        matrix[indices[known], column.drop_null().to_numpy()] = table.column("p").to_numpy()[known]
        sides.append((names.dictionary.to_pylist(), matrix))
    (names, shares), (others, other_shares) = sides
    lang, rows = left.column("lang")[0].as_py(), []
    for name, mine in zip(names, shares):
        sums = np.abs(other_shares - mine).sum(axis=1)
        rows += [(lang, name, other, int(s), len(terms)) for other, s in zip(others, sums) if name < other]
    if not rows:
        return schema.empty_table()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the summed differences of every two sources of a language.

    Terms are dealt to slices and sources to blocks; a slice of two blocks is a cell. Every source has a row in every slice, so that it
    meets all others. Terms that neither side of a cell has differ by the shares of a count of 0, all alike.
    """
    slices = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK_TERMS))
    blocks = F.ceil(F.col("sources") / BLOCK_SOURCES)
    block = F.pmod(F.xxhash64("source"), F.col("blocks"))
    sized = groups.withColumns({"slices": slices, "blocks": blocks}).select("lang", "source", "base", "slices", "blocks", block.alias("block"))
    marks = sized.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p"), "base", "block", "blocks",
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    # a matter of rows per language and source, joined by those keys
    places = shares.join(sized.withColumnsRenamed({"lang": "_lang", "source": "_source"}), (F.col("lang") == F.col("_lang")) & (
        F.col("source") == F.col("_source"))).select(
        "lang", "source", "term", "p", "base", "block", "blocks", F.pmod(F.xxhash64("term"), F.col("slices")).alias("slice"))
    cells = written(marks.unionByName(places), "cells")
    columns = ("lang", "source", "term", "p", "base", "slice")
    first = cells.select(*columns, F.col("block").alias("a"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("b"))
    second = cells.select(*[F.col(c).alias(c) for c in columns], F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("a"), F.col("block").alias("b"))
    keys = ("lang", "slice", "a", "b")
    sums = first.groupBy(*keys).cogroup(second.groupBy(*keys)).applyInArrow(
        _distances, "lang string, source string, other string, sum long, terms long",
    ).groupBy("lang", "source", "other").agg(F.sum("sum").alias("sum"), F.sum("terms").alias("met"))

    base = groups.select("lang", "source", "base", "terms")
    named = sums.join(base, ["lang", "source"]).join(
        base.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base")), ["lang", "other"])
    value = F.col("sum") + (F.col("terms") - F.col("met")) * F.abs(F.col("base") - F.col("other_base"))
    both = F.explode(F.array(F.struct(F.col("source").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    return named.select("lang", value.alias("value"), both.alias("pair")).select("lang", "pair.source", "pair.item", "value")


def audit_sources(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source", min_docs: int = MIN_DOCS,
    listed: int = LISTED,
) -> DataFrame:
    """How far the sources of each language differ, and by which terms: lang, source, part, item, value, rank.

    Part ``pair`` has one row per source and other source of its language, with the summed difference of their shares over all
    kept terms. Part ``term`` has a source's ``listed`` terms whose share exceeds that of the language by most. A language
    keeps the terms that at least ``min_docs`` of its documents hold. Ranks go by value, then by item in byte order.

    Null texts, languages and sources are empty strings, which is a language and a source like others. Documents without terms make their
    source occur all the same. Repeated rows are documents of their own. An empty table gives no rows. Only the three named columns are
    read. Whole texts are read, of any length.

    Every task sorts pointers to the starts of its terms (:func:`sort_pointers`), and equal runs give its counts. These are added up per
    language, source and term, so that a hot source or term is one row per task; documents per term are added up from there.
    """
    counts = written(count_terms(docs, text_column, lang_column, source_column), "terms")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(
        F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "kept")
    used = written(counts.select("lang", "source", "term", "n").join(broadcast_if_small(kept), ["lang", "term"]), "used")
    occurring = docs.select(*[text_or_empty(c).alias(name) for c, name in ((lang_column, "lang"), (source_column, "source"))]).distinct()
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    zero = F.lit(0).cast("long")
    groups = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")])
    per_lang = groups.groupBy(F.col("lang").alias("l")).agg(F.count("*").alias("sources"))
    base = F.when(F.col("terms") > 0, share(zero, F.col("total"), F.greatest("terms", F.lit(1)))).otherwise(0)
    groups = written(groups.join(per_lang, F.col("lang") == F.col("l")).drop("l").withColumn("base", base), "groups")

    of_group = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "total", "terms", "lang_total")
    shares = written(
        used.join(of_group, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s"))).select(
            "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")), "shares")
    discard(counts, kept, used)
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")).withColumn(
        "rank", F.row_number().over(best)).filter(F.col("rank") <= listed)
    pairs = _pairs(shares.select("lang", "source", "term", "p"), groups).withColumn("rank", F.row_number().over(best))
    columns = ("item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), *columns).unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), *columns))
