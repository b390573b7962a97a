"""Helpers the operators share: written intermediate tables, size-checked broadcasts, text columns."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of two or three numbers that may be broadcast: at most about 30 MB.
BROADCAST_ROWS = 1_000_000
#: A word is a run of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a made-up one only on a local master without that setting."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="aeroweave-llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, and a lost executor costs no recomputation.

    The files are deleted when the session's file system closes, or earlier by :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target, fs = _file_system(spark, path)
    fs.deleteOnExit(target)
    again = spark.read.schema(df.schema).parquet(path)
    again._llm_path = path
    return again


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for table in tables:
        target, fs = _file_system(table.sparkSession, table._llm_path)
        fs.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def broadcast_if_small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of narrow rows when they were counted to be few; adaptive joins take the rest."""
    return F.broadcast(table) if table.count() <= limit else table


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
          "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
          "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
          "array<binary>": pa.list_(pa.binary())}


def arrow_schema(ddl: str) -> pa.Schema:
    """``name type, ...`` as an Arrow schema, for use inside tasks."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (re.split(r" +", part.strip()) for part in ddl.split(","))])


#: Rows whose texts a task turns into Python objects at a time.
SLICE_ROWS = 512


def sliced(parts: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of few rows, without a copy: what a task holds as Python objects stays small."""
    for part in parts:
        for start in range(0, part.num_rows, rows):
            yield part.slice(start, rows)


def record_batch(rows: Iterable[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
