import pytest

from tallyframe import Catalog, Cell, CohortReport, standard_catalog
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, REFINE
from testbed.queries import BOUNDS

ROWS = [
    {"p918": "1", "p301": "1", "p1704": "10", "p3000": "AK"},
    {"p918": "1", "p301": "0", "p1704": "20", "p3000": "AK"},
    {"p918": "1", "p301": "2", "p1704": "30", "p3000": "AL"},
    {"p918": "2", "p301": "2", "p3000": "AZ"},
    {"p918": "1", "p301": "1", "p1704": "40", "p3000": "LONG"},
    {"p918": "1", "p301": "1", "p1704": "50.5"},
]

CELLS = [
    Cell("A", COUNT, predicate="p918 = 1"),
    Cell("B", REFINE, parent="A", predicate="p301 > 0"),
    Cell("M", MEDIAN, predicate="p918 = 1 AND p1704 > 0"),
    Cell("R", RATIO, num="B", den="A"),
]


def values(run, column="actual"):
    return {(r["cell"], r["subset"]): r[column] for r in run.results().collect()}


@pytest.fixture
def data(make_input):
    return make_input(ROWS)


def test_mode_default(data):
    got = values(CohortReport(data, Catalog(CELLS)))
    assert got[("A", "ALL")] == "3" and got[("A", "AZ")] == "0"
    assert got[("M", "ALL")] == "30.0" and ("M", "AK") not in got
    assert got[("R", "ALL")] == "0.6666666666666666" and ("R", "AK") not in got


def test_mode_national(data):
    got = values(CohortReport(data, Catalog(CELLS), mode="national"))
    assert got == {("A", "ALL"): "5", ("B", "ALL"): "4", ("M", "ALL"): "30.0", ("R", "ALL"): "0.8"}


def test_mode_subsets(data):
    run = CohortReport(data, Catalog(CELLS), mode="subsets")
    got = values(run)
    assert got[("A", "ALL")] == "3" and got[("B", "AK")] == "1"
    assert got[("M", "AK")] == "15.0" and got[("M", "AZ")] == "undefined" and ("M", "ALL") not in got
    assert got[("R", "AK")] == "0.5" and got[("R", "AZ")] == "a/0" and ("R", "ALL") not in got
    operands = {(r["cell"], r["subset"]): (r["numerator_text"], r["denominator_text"]) for r in run.results().collect()}
    assert operands[("R", "AZ")] == ("0", "0") and operands[("R", "AK")] == ("1", "2")
    with_nation = values(CohortReport(data, Catalog(CELLS), mode="subsets", national_medians=True))
    assert with_nation[("M", "ALL")] == "30.0"


def test_mode_both_takes_all_rows_for_the_nation(data):
    got = values(CohortReport(data, Catalog(CELLS), mode="both"))
    assert got[("A", "ALL")] == "5" and got[("A", "AL")] == "1"
    assert got[("R", "ALL")] == "0.8" and got[("R", "AL")] == "1.0"
    with pytest.raises(ValueError):
        CohortReport(data, Catalog(CELLS), mode="planetary")


def test_static_subsets(data):
    got = values(CohortReport(data, Catalog(CELLS), mode="subsets", subsets=["AK", "WY"]))
    assert got[("A", "ALL")] == "2" and got[("A", "WY")] == "0"
    assert got[("M", "WY")] == "undefined" and got[("R", "WY")] == "a/0"
    assert not any(s == "AL" for _, s in got)


def test_another_subset_column(data):
    got = values(CohortReport(data, Catalog(CELLS), subset_column="p301", cells=["A"]))
    assert got == {("A", "0"): "1", ("A", "1"): "3", ("A", "2"): "1", ("A", "ALL"): "5"}


def test_empty_input(make_input):
    got = values(CohortReport(make_input([]), Catalog(CELLS), mode="both"))
    assert got == {("A", "ALL"): "0", ("B", "ALL"): "0", ("M", "ALL"): "undefined", ("R", "ALL"): "a/0"}
    assert values(CohortReport(make_input([]), Catalog(CELLS), mode="national")) == got


def test_failures_stay_with_their_cell(data):
    cells = [
        *CELLS,
        Cell("bad", COUNT, predicate="nothing = 1"),
        Cell("broken", COUNT, predicate="p918 = = 1"),
        Cell("number", COUNT, predicate="p918"),
        Cell("badmedian", MEDIAN, predicate="p918 = 1", value="p1"),
        Cell("onbad", RATIO, num="bad", den="A"),
        Cell("orphan", REFINE, parent="nobody", predicate="p918 = 1"),
    ]
    got = values(CohortReport(data, Catalog(cells), mode="subsets", cells=[*Catalog(cells).names(), "gone"]))
    for name in ("bad", "broken", "number", "badmedian", "orphan"):
        assert got[(name, "ALL")] == "FAILED" and (name, "AK") not in got
    assert got[("gone", "ALL")] == "MISSING"
    assert got[("onbad", "AK")] == "FAILED" and ("onbad", "ALL") not in got
    assert got[("A", "AK")] == "2"


def test_ratio_needs_its_operands_in_the_run_and_before_it(data):
    for order in (["R"], ["A", "R", "B"]):
        assert values(CohortReport(data, Catalog(CELLS), mode="national", cells=order))[("R", "ALL")] == "FAILED"


def test_ratio_of_medians_and_ratios(data):
    cells = [
        *CELLS,
        Cell("E", MEDIAN, predicate="p918 = 7"),
        Cell("MM", RATIO, num="M", den="A"),
        Cell("RR", RATIO, num="R", den="A"),
        Cell("ME", RATIO, num="E", den="A"),
    ]
    run = CohortReport(data, Catalog(cells), mode="national")
    got = values(run)
    assert got[("MM", "ALL")] == "6.0" and got[("RR", "ALL")] == "0.16" and got[("ME", "ALL")] == "FAILED"
    assert values(run, "numerator_text")[("MM", "ALL")] == "30.0"
    assert values(run, "denominator_text")[("MM", "ALL")] == "5"


def test_medians_or_ratios_alone(data):
    only = values(CohortReport(data, Catalog(CELLS), mode="both", cells=["M"]))
    assert only == {("M", "ALL"): "30.0", ("M", "AK"): "15.0", ("M", "AL"): "30.0", ("M", "AZ"): "undefined"}
    listed = values(CohortReport(data, Catalog(CELLS), mode="subsets", subsets=["WY"], cells=["M"]))
    assert listed == {("M", "WY"): "undefined"}
    nation = values(CohortReport(data, Catalog(CELLS), mode="national", cells=["M"]))
    assert nation == {("M", "ALL"): "30.0"}


def test_names_with_quotes(data):
    cells = [Cell("it's \\ here", COUNT, predicate="p3000 = 'AK'")]
    assert values(CohortReport(data, Catalog(cells), mode="national")) == {("it's \\ here", "ALL"): "2"}


def test_sentinel_wage_is_not_a_wage(make_input):
    rows = [{"p918": "1", "p923": "00", "p901": "20000101", "p1704": w, "p3000": "AK"} for w in ("999999.99", "0", "7")]
    got = values(CohortReport(make_input(rows), standard_catalog(), BOUNDS, mode="national", cells=["G29"]))
    assert got == {("G29", "ALL"): "7.0"}


def test_or_precedence_shows_in_the_standard_report(make_input):
    rows = [
        {"p918": "1", "p900": "20000101", "p3000": "AK"},
        {"p918": "2", "p1002": "20010101", "p1101": "20010101", "p3000": "AK"},
        {"p918": "2", "p1002": "20010101", "p3000": "AK"},
    ]
    data = make_input(rows)
    textual = values(CohortReport(data, standard_catalog(), BOUNDS, mode="national", cells=["F10", "F11", "F12"]))
    assert [textual[(c, "ALL")] for c in ("F10", "F11", "F12")] == ["3", "3", "2"]
    wrapped = values(CohortReport(data, standard_catalog(True), BOUNDS, mode="national", cells=["F10", "F11", "F12"]))
    assert [wrapped[(c, "ALL")] for c in ("F10", "F11", "F12")] == ["3", "2", "1"]


def test_run_stats(data):
    stats = CohortReport(data, Catalog(CELLS)).run_stats().first()
    assert (stats["rows"], stats["cells"], stats["subsets"], stats["calculations"]) == (6, 4, 3, 72)
    static = CohortReport(data, Catalog(CELLS), subsets=["AK", "WY"]).run_stats().first()
    assert (static["rows"], static["subsets"], static["cell_values"]) == (6, 2, 8)


def test_the_nation_is_not_a_subset(data):
    with pytest.raises(ValueError):
        CohortReport(data, Catalog(CELLS), subsets=["AK", "ALL"])
