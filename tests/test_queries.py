"""Every registered query against DuckDB on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import difference, duck
from testbed.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_point.oracle_sql()) and set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    frame = entry_point.queries()[name](spark, SF_DIR)
    assert difference(frame, con, entry_point.oracle_sql()[name]) is None


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.columns == ["cell", "subset", "value", "numerator", "denominator", "status"]
    assert frame.count() == 252 * (1 + frame.where("subset <> 'ALL'").select("subset").distinct().count())
