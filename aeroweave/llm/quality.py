"""Quality rules: per-text counts, and lines that too many documents of a host share."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import arrow_schema, broadcast_if_small, record_batch, sliced, written

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A line is common when at least so many of its host's distinct texts hold it, and more than LINE_ROOT times the root of their
#: number: 45 of 500, 200 of 10,000, 2,000 of a million. So a larger host takes more, but a smaller share of its texts.
LINE_DOCS = 20
LINE_ROOT = 2
#: A document is depleted when less than this share of its words is left without the common lines.
KEPT_SHARE = 0.2
_SYMBOLS = str.maketrans("", "", "#*$%&|<>")
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_SCHEMA = (
    "__row long, __id long, __text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, __host long, __keys array<long>, __sizes array<int>")
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice in ``words``, the first occurrence included."""
    if len(words) <= window:
        return 0
    grams = list(zip(*(words[i:] for i in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    counts, covered, end = Counter(grams), 0, 0
    for at, gram in enumerate(grams):
        if counts[gram] > 1:
            covered += at + window - max(at, end)
            end = at + window
    return covered


def signed_hash(data: bytes, seed: int = 0) -> int:
    value = xxhash.xxh64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def text_counts(text: str) -> tuple:
    """Words, their code points, symbols, repeated lines, words in repeated windows, and (key, words) of each line."""
    seen, repeats, keys, sizes, all_words = set(), 0, [], [], []
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        if not words:
            continue
        repeats += line in seen
        seen.add(line)
        all_words += words
        keys.append(b" ".join(words).lower().translate(_DIGITS))
        sizes.append(len(words))
    chars = len(b"".join(all_words).decode("utf-8", "surrogatepass"))
    return len(all_words), chars, len(text) - len(text.translate(_SYMBOLS)), repeats, repeated_words(all_words), keys, sizes


def _features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = arrow_schema(_SCHEMA)
    for part in sliced(parts):
        rows = []
        for row, doc_id, text, host in zip(*(part.column(i).to_pylist() for i in range(4))):
            text = text or ""
            site = b"\x00" if host is None else host.encode()
            *counts, lines, sizes = text_counts(text)
            key = signed_hash(text.encode("utf-8", "surrogatepass"))
            seed = xxhash.xxh64_intdigest(site)
            rows.append((row, doc_id, key, *counts, signed_hash(site), [signed_hash(x, seed) for x in lines], sizes))
        yield record_batch(rows, schema)


def _judged(
    docs: DataFrame, id_column: str, text_column: str, host_column: str, line_docs: int, line_root: float, kept_share: float,
    with_lines: bool,
) -> DataFrame:
    """As :func:`judge_quality`; ``with_lines`` adds ``__gone``, the keys of a row's common lines (null if none)."""
    features = written(
        docs.select(F.monotonically_increasing_id(), F.col(id_column).cast("long").alias("__id"), F.col(text_column).cast("string").alias("__text"),
                    F.col(host_column).cast("string").alias("__site")).mapInArrow(_features, _SCHEMA), "lines")
    held = features.select("__host", "__text_key", F.explode(F.array_distinct("__keys")).alias("__key"))
    counts = held.groupBy("__host", "__key").agg(F.countDistinct("__text_key").alias("n")).filter(F.col("n") >= line_docs)
    hosts = features.groupBy("__host").agg(F.countDistinct("__text_key").alias("all"))
    over = F.col("n") * F.col("n") > line_root * line_root * F.col("all")
    common = written(counts.join(hosts, "__host").filter(over).select("__key"), "common")

    lines = features.select("__row", F.explode(F.arrays_zip("__keys", "__sizes")).alias("line")).select(
        "__row", F.col("line.__keys").alias("__key"), F.col("line.__sizes").alias("size"))
    gone = [F.collect_set("__key").alias("__gone")] if with_lines else []
    lost = lines.join(broadcast_if_small(common), "__key").groupBy("__row").agg(F.sum("size").alias("lost"), *gone)
    judged = features.select("__row", "__id", *_BASE).join(lost, "__row", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    return judged.select(
        F.col("__id").alias(id_column), *_BASE, F.coalesce("lost", F.lit(0)).cast("long").alias("n_common_words"),
        failed.alias("base_failed"), (~failed & (left >= kept_share * F.col("n_words"))).alias("kept"), *(["__gone"] if with_lines else []))


def judge_quality(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source",
    line_docs: int = LINE_DOCS, line_root: float = LINE_ROOT, kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """Counts and verdict for every row of ``docs``.

    The base rules reject texts of under 10 words or with over 20 % of their words in repeated 5-word windows.
    Then lines are compared with white space collapsed, A-Z lower-cased and digits alike: of each host, a line held
    by more than ``line_root`` times the root of the number of its distinct texts, ``line_docs`` at least, is common. Exact copies of a
    text count once, so being copied makes no line common. A document with less than ``kept_share`` of its words outside common
    lines is depleted and not kept. An empty table gives no rows; texts may be of any length.

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_common_words, base_failed, kept: a row for
    each row of the input, repeated ones included. A null or empty text has no words and fails the base rules; a null
    host is a host of its own.

    Each text is read once; its line hashes go to a table in the shared folder. Counting sends one row per distinct
    (line, text) and task, without texts. Common lines are broadcast only when counted to be few.
    """
    return _judged(docs, id_column, text_column, host_column, line_docs, line_root, kept_share, False)


def without_lines(text: str, host: str | None, gone: set[int]) -> str:
    """``text`` without the lines whose keys on ``host`` are among ``gone``; all other lines as they are."""
    seed = xxhash.xxh64_intdigest(b"\x00" if host is None else host.encode())

    def stays(line: bytes) -> bool:
        words = line.split()
        return not words or signed_hash(b" ".join(words).lower().translate(_DIGITS), seed) not in gone

    return b"\n".join(filter(stays, text.encode("utf-8", "surrogatepass").split(b"\n"))).decode("utf-8", "surrogatepass")


def _cut(texts: pd.Series, hosts: pd.Series, gone: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else without_lines(t, h, set(g)) for t, h, g in zip(texts, hosts, gone)], dtype=object)


def clean_quality(
    docs: DataFrame, text_column: str = "text", host_column: str = "source", line_docs: int = LINE_DOCS,
    line_root: float = LINE_ROOT, kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, their text without the lines that are common on their host.

    All columns are kept; ``__n_cut`` is added, the number of different lines cut (case, digits and white space alike). Verdict
    and cut depend on text and host alone and are joined on a hash of both, so rows that share an id, or have none, each stay or go by
    their own text. Lines, nulls, repeated rows and empty tables are as in :func:`judge_quality`. The names ``__key_of``, ``__gone``, ``__cut`` and
    ``__n_cut`` are taken.
    """
    text, host = F.col(text_column).cast("string"), F.col(host_column).cast("string")
    keyed = docs.withColumn("__key_of", F.xxhash64(F.coalesce(text, F.lit("")), F.coalesce(host, F.lit("\x00"))))
    judged = _judged(keyed, "__key_of", text_column, host_column, line_docs, line_root, kept_share, True)
    kept = judged.filter("kept").select("__key_of", "__gone").dropDuplicates(["__key_of"])
    joined = keyed.join(kept, "__key_of")
    some = F.col("__gone").isNotNull()
    cut = F.pandas_udf(_cut, "string")(F.when(some, text), F.when(some, host), F.col("__gone"))
    return joined.withColumn("__cut", cut).withColumn(text_column, F.when(some, F.col("__cut")).otherwise(text)).withColumn(
        "__n_cut", F.when(some, F.size("__gone")).otherwise(0)).select(
        *docs.columns, "__n_cut")
