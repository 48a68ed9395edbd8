import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tallyframe import layout  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_raw(spark):
    """Raw records from dictionaries of the columns that matter; the rest is NULL."""

    def make(rows):
        schema = ", ".join(f"{c} string" for c in layout.KEPT_COLUMNS)
        data = [tuple(r.get(c.replace("PIRL", "p")) for c in layout.KEPT_COLUMNS) for r in rows]
        return spark.createDataFrame(data, schema)

    return make


@pytest.fixture(scope="session")
def make_input(make_raw):
    from tallyframe.operators import prepare_input

    return lambda rows: prepare_input(make_raw(rows))
