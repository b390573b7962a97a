import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, host string, key long, rate double, table string, "
        "id string, row long, gram string, fingerprint string")


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
def documents(spark):
    """(doc_id, text, source) rows as documents with two more columns whose names clash with internal ones."""
    def make(rows):
        full = [(i, t, "en", s, None if t is None else len(t), "clash", 7, 0.5, "clash", "clash", 7, "clash", "clash")
                for i, t, s in rows]
        return spark.createDataFrame(full, DOCS)
    return make
