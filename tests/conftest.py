import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("aeroweave-tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def table(spark):
    """Rows and a DDL schema to a DataFrame; columns ending in _ts hold text times."""
    def make(rows, schema):
        from pyspark.sql import functions as F

        texts = schema.replace("timestamp_ntz", "string")
        df = spark.createDataFrame(rows, texts)
        times = [part.split()[0] for part in schema.split(",") if part.split()[1] == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df
    return make


@pytest.fixture
def values():
    """One column of a DataFrame as a list, ordered by another."""
    def pick(df, column, order):
        return [r[column] for r in df.orderBy(order).select(column, order).collect()]
    return pick
