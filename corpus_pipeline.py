"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, mixing; each stage reads the one before.

Every stage takes documents with doc_id, text, source and n_chars, of any length, and keeps further columns as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroweave.llm import decontaminate, lines, mixing, quality, simhash
from aeroweave.llm.shared import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines common on their host; ``n_chars`` of cut texts counted anew.

    Null and empty texts fail the rules, a null host is a host, repeated rows are judged alike, an empty table stays empty.
    """
    clean = quality.clean_quality(docs)
    chars = F.when(clean["__n_cut"] > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", chars).select(docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without boilerplate lines, their ``n_chars`` counted anew; those of which nothing but white space is left go.

    Texts that were null or empty before stay as they are; a null site is a site, repeated rows are cut alike.
    """
    cut = lines.dedup_lines(docs)
    chars = F.when(cut["__n_removed"] > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    cut = cut.withColumn("n_chars", chars)
    emptied = (cut["__n_removed"] > 0) & ~cut["text"].rlike(r"[^\x20\x09-\x0D]")
    return cut.filter(~emptied).select(docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints of 3-word shingles, linked at 2 or fewer differing bits.

    The one with the smallest id stays, null ids last; texts without a word are one group.
    """
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null and empty texts hold none."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources have equal shares, in random order; ``copy`` counts from 1 and replaces a column of that name.

    A null source is a source, null and empty texts have no characters, repeated rows and null ids are repeated alike.
    """
    return mixing.mix_sources(docs.drop("copy")).withColumnRenamed("__copy", "copy")


STAGES = [
    ("quality rules", keep_quality), ("line dedup", cut_lines), ("near-dedup", keep_one_of_each),
    ("decontamination", drop_leaks), ("mixing", mix),
]
#: SQL has no SimHash groups and no banded alignment; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
