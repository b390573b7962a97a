"""Benchmark decontamination: q-grams counted in diagonal bands, then banded alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import arrow_schema, record_batch, sliced

#: Characters of a gram; eight single bytes are one number.
GRAM = 8
#: Edits allowed per character of an item.
EDIT_SHARE = 0.08
#: Shorter items (white space collapsed) are searched for as they are, between word borders, without edits.
MIN_CHARS = 24
#: Characters of benchmark that one scan holds; larger benchmarks are scanned for in blocks.
BLOCK_CHARS = 1_000_000
_TABLE_BITS = 20
_SCHEMA = "id long, item_id long, edits int, start int, stop int"


def plain(text: str) -> str:
    """Lower case, white space collapsed."""
    return " ".join(text.lower().split())


def _numbers(text: str) -> np.ndarray:
    """Every run of GRAM characters as a number; characters outside one byte share a sign, so grams may only match more."""
    data = text.encode("latin-1", "replace")
    return np.ndarray((max(0, len(data) - GRAM + 1),), "<u8", data, 0, (1,)) if len(data) >= GRAM else np.zeros(0, "<u8")


def _slot(numbers: np.ndarray) -> np.ndarray:
    return (numbers * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _TABLE_BITS)


def band_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits that turn ``item`` into a part of ``text`` along the diagonals 0 to len(text) - len(item), and its end.

    Row by row of the item; the diagonals of a row are one vector.
    """
    diagonals = len(text) - len(item) + 1
    steps = np.arange(diagonals, dtype=np.int32)
    row = np.zeros(diagonals, np.int32)
    for i, sign in enumerate(item):
        changed = row + (text[i:i + diagonals] != sign)
        changed[:-1] = np.minimum(changed[:-1], row[1:] + 1)
        row = np.minimum.accumulate(changed - steps) + steps
    best = int(row.argmin())
    return int(row[best]), best + len(item)


class Items:
    """Benchmark items ready to be searched for: their grams in order, and a bit table that rules most numbers out."""

    def __init__(self, rows: list[tuple[int, str]], edit_share: float = EDIT_SHARE, min_chars: int = MIN_CHARS):
        flat = [(item_id, plain(t or "")) for item_id, t in rows]
        kept = [(item_id, text) for item_id, text in flat if len(text) >= max(min_chars, GRAM)]
        #: ids of short items by their number of words and their text
        self.short: dict[int, dict[str, list[int]]] = {}
        for item_id, text in flat:
            if text and len(text) < max(min_chars, GRAM):
                self.short.setdefault(text.count(" ") + 1, {}).setdefault(text, []).append(item_id)
        self.first_words = {size: {text.split(" ")[0] for text in items} for size, items in self.short.items()}
        self.ids = [item_id for item_id, _ in kept]
        self.signs = [np.array([ord(c) for c in text], np.int32) for _, text in kept]
        sizes = np.array([len(s) for s in self.signs], np.int64)
        self.edits = np.minimum((edit_share * sizes).astype(np.int64), (sizes - GRAM) // GRAM)
        self.needed = sizes - GRAM + 1 - GRAM * self.edits
        grams = [_numbers(text) for _, text in kept]
        numbers = np.concatenate([np.zeros(0, "<u8"), *grams])
        order = np.argsort(numbers, kind="stable")
        self.numbers = numbers[order]
        self.item = np.repeat(np.arange(len(kept)), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in grams)])[order]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[_slot(self.numbers)] = True

    def regions(self, text: str) -> list[tuple[int, int, int]]:
        """(item, least diagonal, greatest diagonal) of every band that shares enough grams with ``text``.

        With at most e edits, an item of m characters keeps m - q + 1 - q * e of its grams, on diagonals that spread
        over e at most. Bands are 2 * (e + 1) wide and overlap by half, so one of them holds all of these.
        """
        numbers = _numbers(text)
        at = np.flatnonzero(self.table[_slot(numbers)])
        first = np.searchsorted(self.numbers, numbers[at], "left")
        counts = np.searchsorted(self.numbers, numbers[at], "right") - first
        total = int(counts.sum())
        if not total or total < self.needed.min():
            return []
        index = np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(total)
        item = self.item[index]
        diagonal = np.repeat(at, counts) - self.place[index]
        likely = np.bincount(item, minlength=len(self.ids)) >= self.needed
        item, diagonal = item[likely[item]], diagonal[likely[item]]
        width = self.edits[item] + 1
        found = []
        for shift in (0, 1):
            band = (diagonal + shift * width) // (2 * width)
            order = np.lexsort((diagonal, band, item))
            i, b, d = item[order], band[order], diagonal[order]
            starts = np.flatnonzero(np.r_[True, (i[1:] != i[:-1]) | (b[1:] != b[:-1])]) if len(i) else np.zeros(0, int)
            stops = np.r_[starts[1:], len(i)].astype(int)
            for s, e in zip(starts, stops):
                if e - s >= self.needed[i[s]]:
                    found.append((int(i[s]), int(d[s]), int(d[e - 1])))
        return found

    def exact(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, 0, start, stop) of the first place of every short item that ``text`` holds as whole words."""
        found: dict[str, tuple[int, int, int]] = {}
        words = text.split(" ") if self.short else []
        starts = np.cumsum([0, *(len(w) + 1 for w in words)]).tolist()
        for size, items in self.short.items():
            for i in range(len(words) - size + 1):
                if words[i] in self.first_words[size]:
                    part = " ".join(words[i:i + size])
                    if part in items:
                        found.setdefault(part, (0, starts[i], starts[i] + len(part)))
        return [(item_id, *place) for part, place in found.items() for item_id in self.short[part.count(" ") + 1][part]]

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, stop) of the best region of every item that ``text`` holds within its edit budget."""
        text = plain(text or "")
        regions = self.regions(text) if self.ids and len(text) >= GRAM else []
        signs = np.array([ord(c) for c in text], np.int32) if regions else None
        best: dict[int, tuple[int, int, int]] = {}
        for item, low, high in regions:
            sign, edits = self.signs[item], int(self.edits[item])
            if best.get(item, (1,))[0] == 0:
                continue
            start, end = low - edits, high + edits + len(sign)
            part = np.pad(signs[max(0, start):end], (max(0, -start), max(0, end - len(signs))), constant_values=-1)
            cost, stop = band_distance(sign, part)
            if cost <= edits:
                stop = min(start + stop, len(text))
                best[item] = min(best.get(item, (edits + 1, 0, 0)), (cost, max(0, stop - len(sign) - cost), stop))
        return [(self.ids[item], *found) for item, found in sorted(best.items())] + self.exact(text)


def _blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about BLOCK_CHARS; an item is a row and stays whole."""
    items = benchmark.select(F.col(item_column).cast("long").alias("i"), F.col(text_column).cast("string").alias("t"))
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS) or 1
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block)
        yield [(row.i, row.t) for row in part.collect()]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", benchmark_text: str = "text",
) -> DataFrame:
    """Every (document, item) where the whole document holds the item within EDIT_SHARE edits per character.

    Returns id, item_id, edits and the matched span (``start``, ``stop``) in the lower-cased text with white space collapsed; the
    start is the earliest the alignment allows. Items of fewer than MIN_CHARS characters are found as they are, as whole words (their first
    place). Documents and items with a null or empty text match nothing; items with the same text each match; repeated rows repeat
    their matches. Texts may be of any length; an empty table of documents or items gives no rows. Documents are scanned in place without a shuffle, once per
    block of the benchmark; a block is bounded, so it may be held by every task.
    """
    columns = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("t"))
    found = None
    for rows in _blocks(benchmark, item_column, benchmark_text):
        held = docs.sparkSession.sparkContext.broadcast(Items(rows))

        def scan(parts: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            schema = arrow_schema(_SCHEMA)
            for part in sliced(parts):
                pairs = zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield record_batch([(i, *m) for i, t in pairs for m in held.value.matches(t)], schema)

        matches = columns.mapInArrow(scan, _SCHEMA)
        found = matches if found is None else found.union(matches)
    return found.withColumnRenamed("id", id_column)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", benchmark_text: str = "text",
) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns and other rows as they are, order included."""
    at = docs.columns.index(text_column)
    for rows in _blocks(benchmark, item_column, benchmark_text):
        held = docs.sparkSession.sparkContext.broadcast(Items(rows))

        def clean(parts: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for part in sliced(parts):
                keep = [not held.value.matches(t) for t in part.column(at).to_pylist()]
                yield part.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
