"""Rejected lines: every line is kept or rejected, with a reason."""

from pyspark.sql import functions as F

from tallyframe.sources import definition_rows, expected_rows, parse_expected, read_reference_checked, reference_rows
from tallyframe.sources.readers import MEASURES_SCHEMA

NAMES = "MeasureID string, Measure string, ReportTypeID string, extra_ string"


def test_reference_rows(spark):
    lines = [("1", "a", "2", "x"), ("1.0", None, " 2 ", "x"), ("x", "b", "y", "x"), (None, "c", "1", None), ("", "", "", ""), ("1", "a", "2", "x"), ("1e2", "d", "3.7", "")]
    rows, bad = reference_rows(spark.createDataFrame(lines, NAMES), MEASURES_SCHEMA, "measures", required=["MeasureID"])
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, "a", 2), (1, None, 2), (1, "a", 2), (100, "d", 3)], key=str)
    assert rows.dtypes == [("MeasureID", "int"), ("Measure", "string"), ("ReportTypeID", "int")]
    assert {tuple(r) for r in bad.collect()} == {
        ("measures", "x,b,y", "MeasureID: no int; ReportTypeID: no int"),
        ("measures", ",c,1", "MeasureID: nothing given"),
        ("measures", ",,", "MeasureID: nothing given"),
    }
    none, nothing = reference_rows(spark.createDataFrame([], NAMES), MEASURES_SCHEMA, "measures")
    assert none.count() == nothing.count() == 0


def test_lines_with_too_many_or_few_fields(spark, tmp_path):
    (tmp_path / "m.csv").write_text("MeasureID,Measure,ReportTypeID\n1,a,2\n2,b\n3,c,1,9\n4,,1\n")
    rows, bad = read_reference_checked(spark, str(tmp_path / "m.csv"), MEASURES_SCHEMA, "m")
    assert sorted(r["MeasureID"] for r in rows.collect()) == [1, 4]
    assert {(r["line"], r["reason"]) for r in bad.collect()} == {("2,b", "number of fields"), ("3,c,1,9", "number of fields")}


def test_expected_rows(spark):
    texts = ["// x", "", "F04-AK = 1", "F04-AK = 3", "F04-AK = 2", "F05", "F06-AL = a = b", "F07 = 0", "F07 = 0"]
    frame = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, at int")
    for order in ([], [F.col("at")]):
        rows, bad = expected_rows(frame, "e.txt", order)
        assert rows.count() + bad.count() == 7
        kept = {(r["cell"], r["subset"]): r["expected"] for r in rows.collect()}
        want = {(r["cell"], r["subset"]): r["expected"] for r in parse_expected(frame, order).collect()}
        assert kept == {k: v for k, v in want.items() if k[0] in ("F04", "F07")}
        assert sorted(r["reason"] for r in bad.collect()) == ["no single value"] * 2 + ["overruled by another line"] * 3


def test_definition_rows(spark):
    given = [
        ("A", "count", "_scfIw_ p918 = 1"), ("B", "nonsense", "_scfIw_ p918 = 1"), ("C", "count", "SELECT 1"), (None, "count", "_scfIw_ p918 = 1"), ("E", None, None),
    ]
    frame = spark.createDataFrame(given, "id string, type string, query string")
    rows, bad = definition_rows(frame, "cells.json")
    assert rows.count() + bad.count() == len(given)
    reasons = {r["line"]: r["reason"] for r in bad.collect()}
    assert [v for k, v in reasons.items() if '"B"' in k] == ["unknown type"] and [v for k, v in reasons.items() if '"C"' in k] == ["no condition"]
    assert "no name" in reasons.values() and "line_" not in rows.columns
