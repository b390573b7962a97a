"""Line dedup by spread over sites: a HyperLogLog sketch per line, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroweave.llm.shared import broadcast_if_small, discard, text_or_empty, written

#: A line seen on this many sites is boilerplate.
MIN_SITES = 10
#: log2 of a sketch's registers; the relative standard error is about 1.04 / sqrt(2 ** 12) = 1.6 %.
SKETCH_BITS = 12
#: Estimates within this share of the threshold (six standard errors) are counted exactly.
BAND = 0.1
_LAST = 2**63 - 1


def line_keys(text: Column) -> Column:
    """A 64-bit hash per ``\\n``-split line, trimmed and lower-cased; null for a line without a word."""
    def key(line):
        plain = F.lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r")))
        return F.when(plain != "", F.xxhash64(plain))
    return F.transform(F.split(text, "\n"), key)


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """Keys of ``lines`` (key, site, doc) that occur on at least ``min_sites`` sites, with their first document.

    Each key gets a sketch of its sites, merged over tasks. Estimates outside the band decide; those inside are
    counted exactly, so the result errs only where a sketch is off by more than the band.
    """
    sketched = lines.groupBy("key").agg(
        F.hll_sketch_agg("site", F.lit(SKETCH_BITS)).alias("sketch"), F.min("doc").alias("first_doc"))
    estimated = written(
        sketched.select("key", "first_doc", F.hll_sketch_estimate("sketch").alias("sites"))
        .filter(F.col("sites") >= min_sites * (1 - band)), "spread")
    sure = estimated.filter(F.col("sites") >= min_sites * (1 + band)).select("key", "first_doc")
    near = estimated.filter(F.col("sites") < min_sites * (1 + band)).select("key", "first_doc")
    counted = (
        lines.join(broadcast_if_small(near.select("key")), "key", "left_semi").groupBy("key")
        .agg(F.countDistinct("site").alias("sites")).filter(F.col("sites") >= min_sites).select("key"))
    found = written(sure.unionByName(near.join(counted, "key", "left_semi")), "boilerplate")
    discard(estimated)
    return found


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """``docs`` without the lines that spread over at least ``min_sites`` sites, plus the counts.

    Every occurrence of such a line goes but the first in the document with the smallest id, so one instance of a
    shared text stays in the corpus. Lines are compared trimmed and lower-cased; lines without a word are never
    boilerplate. A null site counts as one site, a null text stays null, a null id comes after all others. Rows that
    repeat (same id and text) get the same result. All columns are kept; ``__n_lines`` and ``__n_removed`` are added, and the names
    ``__doc``, ``__hash`` and ``__gone`` are taken. Texts may be of any length; an empty table gives no rows.

    Only the positions of boilerplate lines are gathered per document (a row of the input holds them all), and they
    are joined back by id and text hash; hot lines are pre-aggregated in each task.
    """
    named = docs.withColumns({
        "__doc": F.coalesce(F.col(id_column).cast("long"), F.lit(_LAST)), "__hash": F.xxhash64(text_or_empty(text_column))})
    keyed = named.select(
        "__doc", "__hash", F.coalesce(F.col(site_column).cast("string"), F.lit("\x00")).alias("site"),
        line_keys(text_or_empty(text_column)).alias("keys"))
    lines = keyed.select(
        F.explode(F.array_distinct("keys")).alias("key"), "site", F.col("__doc").alias("doc")).filter("key is not null")
    found = spread_lines(lines, min_sites)
    places = keyed.select("__doc", "__hash", F.posexplode("keys").alias("at", "key")).filter("key is not null")
    hits = places.join(broadcast_if_small(found), "key")
    removed = (
        hits.groupBy("__doc", "__hash", "key", "first_doc").agg(F.collect_set("at").alias("ats"))
        .select("__doc", "__hash", F.when(
            F.col("__doc") == F.col("first_doc"), F.array_except("ats", F.array(F.array_min("ats"))))
            .otherwise(F.col("ats")).alias("ats"))
        .groupBy("__doc", "__hash").agg(F.flatten(F.collect_list("ats")).alias("__gone")))
    lines_of = F.split(F.col(text_column), "\n")
    gone = F.coalesce(F.col("__gone"), F.array().cast("array<int>"))
    kept = F.array_join(F.filter(lines_of, lambda _, i: ~F.array_contains(gone, i)), "\n")
    return (
        named.join(removed, ["__doc", "__hash"], "left")
        .withColumns({
            text_column: F.when(F.size(gone) > 0, kept).otherwise(F.col(text_column)),
            "__n_lines": F.when(F.col(text_column).isNull(), 0).otherwise(F.size(lines_of)),
            "__n_removed": F.size(gone)})
        .drop("__doc", "__hash", "__gone"))
