"""Windows as data: one scan for all of them, equal to a run for each."""

import datetime as dt

import pytest

from tallyframe import Catalog, Cell, CohortReport, standard_catalog
from tallyframe.operators import periods, report_windows, window_bounds, window_table
from tallyframe.plans import window_report
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO
from test_periods import COHORTS, MEASURES

ROWS = [
    {"p918": "1", "p900": f"{2000 + i % 18}0{1 + i % 9}11", "p901": f"{2000 + i % 19}0{1 + i % 8}20" if i % 3 else None, "p301": str(i % 4), "p923": "00", "p3000": ["AK", "AL", None][i % 3]}
    for i in range(200)
]


@pytest.fixture(scope="module")
def tables(spark):
    more = [(m, q, 1, f"{1999 + q % 3}-0{m}-01 00:00:00", f"{2000 + q % 3}-0{m}-28 00:00:00") for m in (1, 2, 3) for q in (12, 15)]
    cohorts = spark.createDataFrame(
        [c for c in COHORTS if c[1] == 13] + more, "MeasureID int, QuarterID int, IsActive int, CoveredDataStartDate string, CoveredDataEndDate string"
    )
    return spark.createDataFrame(MEASURES, "MeasureID int, Measure string, ReportTypeID int"), cohorts


def test_table_of_windows(tables):
    table = {(r["quarter"], r["window"]): r.asDict() for r in window_table(*tables).collect()}
    assert set(table) == {(q, w) for q in (12, 13, 15) for w in ("r4q", "cq", "ptd")}
    for quarter in (12, 13, 15):
        for window in ("r4q", "cq", "ptd"):
            want = window_bounds(report_windows(periods(*tables, quarter), window))
            assert {k: v for k, v in table[quarter, window].items() if k not in ("quarter", "window")} == want
    assert window_table(*tables, windows=["cq"], quarters=[13]).count() == 1
    assert window_table(tables[0], tables[1].where("MeasureID <> 2")).count() == 0


def test_equals_a_run_for_each_window(spark, make_input, tables):
    data, cells = make_input(ROWS), ["F04p", "F04", "F05", "F10", "F12", "F27", "F31", "G05n", "G05", "nope"]
    got = window_report(data, standard_catalog(), window_table(*tables), cells).collect()
    found = {}
    for r in got:
        found.setdefault((r["quarter"], r["window"]), set()).add((r["cell"], r["subset"], r["value"], r["numerator"], r["denominator"], r["status"]))
    for (quarter, window), rows in found.items():
        run = CohortReport(data, standard_catalog(), window_bounds(report_windows(periods(*tables, quarter), window)), mode="both", cells=cells)
        want = {tuple(r) for r in run.results().select("cell", "subset", "value", "numerator", "denominator", "status").collect()}
        assert {r for r in rows if r[0] != "nope"} == {r for r in want if r[0] != "nope"}
        assert {(r[1], r[5]) for r in rows if r[0] == "nope"} >= {("ALL", "MISSING")}
    assert len(found) == 9


def test_one_scan_static_subsets_and_failures(spark, make_input, tables, tmp_path):
    make_input(ROWS).write.parquet(str(tmp_path / "p"))
    data = spark.read.parquet(str(tmp_path / "p"))
    cells = [Cell("a", COUNT, predicate="p918 = 1 AND p900 <= :abc_end"), Cell("bad", COUNT, predicate="p3000 rlike '('"), Cell("m", MEDIAN, predicate="p918 = 1"), Cell("r", RATIO, num="a", den="bad")]
    report = window_report(data, Catalog(cells), window_table(*tables), subsets=["AK", "ZZ"])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "p1704" not in plan.split("FileScan parquet")[1].split("ReadSchema")[1]
    got = {(r["cell"], r["subset"], r["status"]) for r in report.where("quarter = 13 AND window = 'cq'").collect()}
    assert got == {(c, s, "OK" if c == "a" else "FAILED") for c in ("a", "bad", "m", "r") for s in ("AK", "ZZ", "ALL")}
    with pytest.raises(ValueError):
        window_report(data, Catalog(cells), window_table(*tables), most_windows=8)


def test_program_to_date_starts_with_the_program(tables):
    starts = {r["abc_start"] for r in window_table(*tables, windows=["ptd"]).collect()}
    assert starts == {dt.date(2016, 7, 1)}
