"""File readers and snapshot selection."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroweave.operators.schema import SEQ
from aeroweave.sources.schemas import FEED_SCHEMAS

READABLE = ("parquet", "csv", "json")


def _ordered(df: DataFrame, row: Column, wanted: bool) -> DataFrame:
    """Add ``_seq``, which orders rows by file name and their place in the file.

    It has to be taken right at the scan. ``row`` numbers the rows of a split; splits are ordered by where they begin.
    """
    if not wanted:
        return df
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), row.alias("row"))
    return df.withColumn(SEQ, place)


def scan_csv(spark: SparkSession, path, schema=None, source_order: bool = False) -> DataFrame:
    """CSV with a header. A schema saves the extra pass type inference needs."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return _ordered(df, F.monotonically_increasing_id(), source_order)


def scan_parquet(spark: SparkSession, path, source_order: bool = False) -> DataFrame:
    df = spark.read.parquet(path)
    return _ordered(df, F.col("_metadata.row_index"), source_order) if source_order else df


def scan_json(spark: SparkSession, path, schema=None, source_order: bool = False) -> DataFrame:
    """Files holding one JSON array of records each."""
    reader = spark.read.option("multiLine", True)
    return _ordered((reader.schema(schema) if schema else reader).json(path), F.monotonically_increasing_id(), source_order)


def load(spark: SparkSession, path: str, schema=None, source_order: bool = False) -> DataFrame:
    """Pick the reader by the path's extension."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in READABLE:
        raise ValueError(f"cannot determine file format for: {path}")
    if kind == "parquet":
        return scan_parquet(spark, path, source_order)
    return (scan_csv if kind == "csv" else scan_json)(spark, path, schema, source_order)


def latest_path(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """Path of the newest matching snapshot, a file or a folder of files, or None.

    Only names and times are listed, nothing is read.
    """
    folder = folder.rstrip("/")
    listing = spark.read.format("binaryFile").load(f"{folder}/{pattern}").select("path", "modificationTime")
    newest = listing.agg(F.max(F.struct("modificationTime", "path")).alias("file")).first()["file"]
    if newest is None:
        return None
    below = newest["path"].split(folder.split(":", 1)[-1].lstrip("/") + "/", 1)[1]
    return f"{folder}/{below.split('/', 1)[0]}"


def latest(spark: SparkSession, folder: str, pattern: str = "*", schema=None, source_order: bool = False) -> DataFrame:
    """Read only the newest file that matches a pattern."""
    try:
        path = latest_path(spark, folder, pattern)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        path = None
    if path is None:
        raise FileNotFoundError(f"no file in {folder} matches {pattern}")
    return load(spark, path, schema, source_order)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path holds readable files, asked of whatever file system it names."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def load_feeds(spark: SparkSession, paths: dict[str, str], source_order: bool = False) -> dict[str, DataFrame]:
    """The feeds whose path exists, by name; text files are read with the feed's types, so no pass infers them."""
    return {
        name: load(spark, path, text_schema(spark, path, name), source_order)
        for name, path in paths.items() if path and path_exists(spark, path)
    }


def text_schema(spark: SparkSession, path: str, feed: str) -> T.StructType | None:
    """Types of the columns a CSV file of a feed names in its header; None for other files and unknown feeds."""
    known = FEED_SCHEMAS.get(feed)
    if known is None or not path.rstrip("/").lower().endswith(".csv"):
        return None
    types = {field.name: field.dataType for field in T.StructType.fromDDL(known).fields}
    header = spark.read.option("header", True).csv(path).columns
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
