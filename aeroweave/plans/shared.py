"""Tables written to the folder all executors share, so that what follows reads them and not their lineage."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from aeroweave.session import ensure_checkpoint_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back.

    A lost executor costs no recomputation of what made it. The files go when the session's file system
    closes, or earlier by :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid4().hex}"
    df.write.parquet(path)
    target, fs = _file_system(spark, path)
    fs.deleteOnExit(target)
    again = spark.read.schema(df.schema).parquet(path)
    again._written_path = path
    return again


def discard(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written` that nothing reads any more."""
    for table in tables:
        target, fs = _file_system(table.sparkSession, table._written_path)
        fs.delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
