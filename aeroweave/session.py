"""Session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session zone: naive feed times are UTC and must not drift with the host."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, preferring the one the cluster names.

    A local folder is only made up when neither the context nor the setting
    ``spark.checkpoint.dir`` names one, and only on a local master: executors of a
    real cluster could not read it back.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="aeroweave-checkpoint-")
    sc.setCheckpointDir(named)
    return named
