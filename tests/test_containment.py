"""Conditions that can't run, or that would raise, stay with their cell; forms of real input files."""

import re

import pytest
from pyspark.sql import functions as F

from tallyframe import Catalog, Cell, CohortReport, standard_catalog
from tallyframe.operators import exact_medians, prepare_input, subset_list
from tallyframe.operators.conditions import analyze
from tallyframe.plans.catalog import COUNT, MEDIAN
from tallyframe.plans.containment import _trials, failing_conditions
from tallyframe.sources import parse_expected

ROWS = [
    {"p918": "1", "p1704": "10", "p900": "20170101", "p3000": "AK"},
    {"p918": "2", "p1704": "20", "p900": "20180101", "p3000": "AL"},
    {"p918": "1", "p1704": "40", "p3000": "AL"},
]
GOOD = Cell("good", COUNT, predicate="p918 = 1")

# condition of a count -> its national value; None for a cell that fails
FORMS = {
    "p918 = 1 -- note": "2",
    "count(*) > 1": None,
    "row_number() over (order by p918) > 1": None,
    "explode(array(true, false))": None,
    "p918 = 1) OR (p918 = 2": None,
    "p3000 = 1": "0",
    "p900 >= 'junk'": "0",
    "1/(p918-1) > 0": "1",
    # raise when they run
    "p3000 rlike '('": None,
    "raise_error('no') = 1": None,
    "to_date(p3000, 'qqqqq') is null": None,
    "element_at(array(1), 0) = p918": None,
    "rand() > 2": None,
    "p918 = 5 AND p3000 rlike '('": None,
    "p3000 rlike p3000": None,
    "element_at(array(1), p918) = 1": None,
    "regexp_extract(p3000, 'A(.)', 2) = 'K'": None,
    "regexp_replace(p3000, 'A', '$1') = 'K'": None,
    "date_format(p900, 'bbb') = 'x'": None,
    "p3000 like 'A\\\\'": None,
    "assert_true(p918 = 1) IS NULL": None,
    "uuid() = 'x'": None,
    # the same functions in forms that can't raise
    "p3000 rlike '^A[KX]'": "1",
    "to_date(p3000, 'yyyy') is null": "3",
    "element_at(array(1), 2) = p918 OR p918 = 2": "1",
    "regexp_extract(p3000, 'A(.)', 1) = 'L'": "2",
    "p3000 like 'A%' AND upper(p3000) in ('AL', 'AK') AND length(trim(p3000)) = 2": "3",
    "year(p900) between 2016 and 2017 AND add_months(p900, 2) > p900": "1",
    "cast(p3000 as int) is null AND p918 * 1000000000 < 0": "0",
}


@pytest.mark.parametrize("form", FORMS)
def test_a_bad_condition_leaves_the_others(spark, make_input, form):
    before = spark.conf.get("spark.sql.ansi.enabled")
    catalog = Catalog([GOOD, Cell("other", COUNT, predicate=form), Cell("m", MEDIAN, predicate="max(p1704) > 1")])
    run = CohortReport(make_input(ROWS), catalog, mode="both")
    got = {(r["cell"], r["subset"]): r["actual"] for r in run.results().collect()}
    assert got[("good", "ALL")] == "2" and got[("good", "AL")] == "1"
    assert got[("other", "ALL")] == (FORMS[form] or "FAILED") and got[("m", "ALL")] == "FAILED"
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_conditions_that_raise_run_only_if_asked_for(spark, make_input):
    catalog = Catalog([GOOD, Cell("m", MEDIAN, predicate="p3000 rlike '('"), Cell("n", MEDIAN, predicate="p3000 rlike p3000")])
    got = {r["cell"]: r["actual"] for r in CohortReport(make_input(ROWS), catalog, mode="national").results().collect()}
    assert got == {"good": "2", "m": "FAILED", "n": "FAILED"}
    asked = CohortReport(make_input(ROWS), Catalog([GOOD, Cell("n", COUNT, predicate="p3000 rlike p3000")]), mode="national", contain=False)
    assert {r["cell"]: r["actual"] for r in asked.results().collect()} == {"good": "2", "n": "3"}


def test_standard_conditions_need_no_trial(spark, make_input):
    texts = [re.sub(r":\w+", "DATE '2017-01-01'", c.predicate) for c in standard_catalog().select() if c.predicate]
    analysis = analyze(make_input(ROWS), texts)
    assert failing_conditions(spark, analysis) == set() and all(_trials(c.node) == [] for c in analysis.values())


def test_threads_that_make_reports_keep_the_setting(spark, make_input):
    from concurrent.futures import ThreadPoolExecutor

    data = make_input(ROWS)
    before = spark.conf.get("spark.sql.ansi.enabled")
    make = lambda _: CohortReport(data, Catalog([GOOD, Cell("c", COUNT, predicate="p3000 = 1")]), mode="national").results().collect()
    with ThreadPoolExecutor(4) as pool:
        assert all({r["cell"]: r["actual"] for r in rows} == {"good": "2", "c": "0"} for rows in pool.map(make, range(8)))
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_session_settings_are_untouched(spark, make_input):
    names = ["spark.sql.codegen.maxFields", "spark.sql.codegen.hugeMethodLimit", "spark.sql.ansi.enabled"]
    before = [spark.conf.get(n) for n in names]
    CohortReport(make_input(ROWS), Catalog([GOOD]), mode="both").results().collect()
    assert [spark.conf.get(n) for n in names] == before


def test_integer_dates_and_decimal_codes(spark):
    codes = {"1.0": 1, " 1": 1, "01": 1, "1e0": 1, "": None, "x": None, "1.9": 1, "99999999999": None}
    raw = spark.createDataFrame([(20170101, c) for c in codes], "PIRL900 int, PIRL918 string")
    got = prepare_input(raw, kept=["PIRL900", "PIRL918"]).collect()
    assert [r["p918"] for r in got] == list(codes.values())
    assert {str(r["p900"]) for r in got} == {"2017-01-01"}


def test_medians_skip_text_that_is_no_number(spark):
    data = spark.createDataFrame([("x",), ("y",), ("5",), (None,)], "v string")
    got = exact_medians(data, {"c": "true"}, "v", F.lit(None).cast("string"), by_subset=False).collect()
    assert [r["median"] for r in got] == [5.0]


def test_national_median_over_many_subsets(spark):
    data = spark.range(20_000).selectExpr("CAST(id % 7 AS STRING) AS v", "concat('s', id % 10000) AS k")
    got = exact_medians(data, {"c": "true"}, "v", F.col("k"), national=True, by_subset=True).where("national").collect()
    assert [r["median"] for r in got] == [3.0]


def test_one_row_per_expected_key(spark):
    lines = spark.createDataFrame([("A-AK = 1",), ("A-AK = 2",), ("B = 3",)], "value string")
    got = sorted((r["cell"], r["subset"], r["expected"]) for r in parse_expected(lines).collect())
    assert got == [("A", "AK", "2"), ("B", "ALL", "3")]


def test_long_codes_of_another_column(spark):
    data = spark.createDataFrame([("01001", 1), ("01003", 1), (None, 1)], "county string, p918 int")
    run = CohortReport(data, Catalog([GOOD]), subset_column="county")
    got = {r["subset"]: r["actual"] for r in run.results().collect()}
    assert got == {"01001": "1", "01003": "1", "ALL": "2"}
    assert subset_list(data, "county", max_length=2).count() == 0
