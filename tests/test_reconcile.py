from tallyframe import Catalog, Cell, CohortReport, layout
from tallyframe.operators import accuracy_summary, compare_expected, report_rows
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO

RESULTS = [
    ("F04", "ALL", None, None, "10", "q"),
    ("F04", "AK", None, None, "4", "q"),
    ("F04p", "ALL", None, None, "12", "q"),
    ("G05", "AK", "2", "4", "0.5", "q"),
    ("G05", "AL", "0", "0", "a/0", "q"),
    ("G06", "ALL", None, None, "FAILED", "q"),
    ("G07", "ALL", None, None, "", "q"),
    ("G08", "ALL", None, None, "", "q"),
]
EXPECTED = [
    ("F04", "ALL", "10"),
    ("F04", "AK", "5"),
    ("F04p", "ALL", ""),
    ("G05", "AK", "0.5"),
    ("G05", "AL", "a/0"),
    ("G07", "ALL", "3"),
    ("ZZZ", "ALL", "1"),
]


def compared(spark):
    results = spark.createDataFrame(
        RESULTS, "cell string, subset string, numerator string, denominator string, actual string, query string"
    )
    return compare_expected(results, spark.createDataFrame(EXPECTED, "cell string, subset string, expected string"))


def test_outcomes(spark):
    got = {(r["cell"], r["subset"]): r for r in compared(spark).collect()}
    outcome = {k: r["outcome"] for k, r in got.items()}
    assert outcome == {
        ("F04", "ALL"): "hit",
        ("F04", "AK"): "miss",
        ("F04p", "ALL"): "missing",
        ("G05", "AK"): "hit",
        ("G05", "AL"): "hit",
        ("G06", "ALL"): "missing",
        ("G07", "ALL"): "missing",
        ("G08", "ALL"): "missing",
    }
    assert got[("F04p", "ALL")]["expected"] == "MISSING" and got[("F04p", "ALL")]["value"] == "12"
    assert got[("G07", "ALL")]["actual"] == "MISSING" and got[("G07", "ALL")]["value"] == ""
    assert got[("G05", "AL")]["value"] == "" and got[("G05", "AL")]["numerator"] == "0"
    assert {r["match"] for r in got.values()} == {"true", "false"}


def test_report_has_nine_columns_in_key_order(spark):
    report = report_rows(compared(spark))
    assert report.columns == layout.REPORT_COLUMNS
    keys = [(r["cell"], r["subset"]) for r in report.collect()]
    assert keys[:3] == [("F04", "ALL"), ("F04", "AK"), ("F04p", "ALL")]


def test_accuracy(spark):
    assert tuple(accuracy_summary(compared(spark)).first()) == (3, 1, 4, 37.5)
    assert accuracy_summary(compared(spark).where("false")).first()["accuracy"] is None


def test_queries_shown_in_the_report(spark, make_input):
    cells = [
        Cell("A", COUNT, predicate="p918 = 1"),
        Cell("M", MEDIAN, predicate="p1704 > 0"),
        Cell("R", RATIO, num="A", den="A"),
    ]
    run = CohortReport(make_input([{"p918": "1", "p1704": "3", "p3000": "AK"}]), Catalog(cells), mode="both")
    expected = spark.createDataFrame([("M", "AK", "3.0")], "cell string, subset string, expected string")
    rows = {(r["cell"], r["subset"]): r for r in run.report(expected).collect()}
    assert rows[("M", "AK")]["query"] == "p1704 > 0 AND p3000 = 'AK'" and rows[("M", "AK")]["match"] == "true"
    assert rows[("R", "AK")]["query"] == "A-AK/A-AK" and rows[("R", "ALL")]["query"] == "A/A"
    assert rows[("R", "AK")]["numerator"] == "1" and rows[("A", "ALL")]["query"] == "p918 = 1"
    assert tuple(run.accuracy(expected).first()) == (1, 0, 5, 1 / 6 * 100)


def test_numbers_in_another_writing(spark):
    rows = [("c", "12", "count"), ("m", "1.5", "median"), ("r", "0.1", "ratio"), ("d", "0.1", "ratio"), ("z", "a/0", "ratio"), ("u", "undefined", "median"), ("f", "0.1", "median")]
    wants = {"c": "12.0", "m": "1.50E0", "r": "+0.10", "d": "0.1000000001", "z": "a/0", "u": "0", "f": "0.10000000149"}
    results = spark.createDataFrame([(c, "ALL", "", "", a, "", k) for c, a, k in rows], "cell string, subset string, numerator string, denominator string, actual string, query string, kind string")
    expected = spark.createDataFrame([(c, "ALL", v) for c, v in wants.items()], "cell string, subset string, expected string")
    outcomes = lambda **o: {r["cell"]: r["outcome"] for r in compare_expected(results, expected, **o).collect()}
    assert outcomes(by_number=True) == {"c": "hit", "m": "hit", "r": "hit", "d": "miss", "z": "hit", "u": "miss", "f": "hit"}
    assert outcomes() == {c: "hit" if c == "z" else "miss" for c in wants}
