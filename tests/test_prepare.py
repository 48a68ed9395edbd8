import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from tallyframe import layout
from tallyframe.operators import prepare_input, publish_input, subset_list


def test_types_and_malformed_values(make_raw):
    rows = [
        {"p900": "20200229", "p918": "01", "p1704": "12.5", "p3000": "AK"},
        {"p900": "20200230", "p918": "x", "p1704": "", "p3000": ""},
        {"p900": "2020-1-1", "p918": " 2 ", "p1704": "abc"},
        {},
    ]
    out = prepare_input(make_raw(rows)).select("p900", "p918", "p1704", "p3000").collect()
    assert [tuple(r) for r in out] == [
        (dt.date(2020, 2, 29), 1, 12.5, "AK"),
        (None, None, None, ""),
        (None, 2, None, None),
        (None, None, None, None),
    ]


def test_schema(make_raw):
    schema = prepare_input(make_raw([])).schema
    assert [f.name for f in schema] == [c.replace("PIRL", "p") for c in layout.KEPT_COLUMNS]
    kinds = {f.name: f.dataType.typeName() for f in schema}
    assert {kinds[c] for c in layout.DATE_COLUMNS} == {"date"}
    assert {kinds[c] for c in layout.CODE_COLUMNS} == {"integer"}
    assert (kinds["p1704"], kinds["p3000"]) == ("float", "string")


def test_columns_are_configurable(make_raw):
    raw = make_raw([{"p900": "20200101", "p3000": "AK"}])
    out = prepare_input(raw, kept=["PIRL900", "PIRL3000"])
    assert out.columns == ["p900", "p3000"]
    assert prepare_input(raw, kept=["PIRL900"], dates=[]).schema["p900"].dataType.typeName() == "string"
    with pytest.raises(AnalysisException):
        prepare_input(raw, kept=["PIRL900", "PIRL31337"]).collect()


def test_typed_sources_are_kept(spark, make_raw):
    raw = make_raw([{"p900": "20200101"}]).selectExpr("to_date(PIRL900, 'yyyyMMdd') AS PIRL900")
    assert prepare_input(raw, kept=["PIRL900"]).first()[0] == dt.date(2020, 1, 1)


def test_partitions_only_on_request(make_raw):
    raw = make_raw([{"p918": str(i)} for i in range(20)])
    count = raw.rdd.getNumPartitions()
    assert prepare_input(raw).rdd.getNumPartitions() == count
    assert prepare_input(raw, partitions=3).rdd.getNumPartitions() == 3


def test_publish(spark, make_input):
    publish_input(make_input([{"p918": "1"}, {"p918": "2"}]), persist=True)
    assert spark.sql("SELECT count(*) FROM input WHERE p918 = 1").first()[0] == 1
    assert spark.catalog.isCached("input")
    spark.catalog.uncacheTable("input")


def test_subset_list(make_input):
    data = make_input([{"p3000": c} for c in ("AK", "AK", "", "ABC", None, "B")])
    assert sorted(r[0] for r in subset_list(data).collect()) == ["", "AK", "B"]
