import datetime as dt

import pytest

from tallyframe.operators import periods, report_windows, window_bounds

D = dt.date
MEASURES = [
    (1, "Number Served (Reportable Individual)", 1),
    (2, "Employment Rate Second Quarter After Exit", 1),
    (3, "Employment Rate Fourth Quarter After Exit", 1),
    (4, "Other", 2),
]
COHORTS = [
    (1, 13, 1, "2000-07-01 00:00:00", "2001-06-30 00:00:00"),
    (2, 13, 1, "1999-07-01 00:00:00", "2001-05-30 00:00:00"),
    (3, 13, 1, "1999-01-01", "1999-12-31"),
    (4, 13, 1, "2000-01-01 00:00:00", "2000-12-31 00:00:00"),
    (1, 13, 0, "1990-01-01 00:00:00", "1990-12-31 00:00:00"),
    (1, 12, 1, "2000-04-01 00:00:00", "2001-03-31 00:00:00"),
    (1, 11, 1, "2000-01-01 00:00:00", "2000-12-31 00:00:00"),
    (9, 13, 1, "2000-01-01 00:00:00", "2000-12-31 00:00:00"),
]


@pytest.fixture
def table(spark):
    measures = spark.createDataFrame(MEASURES, "MeasureID int, Measure string, ReportTypeID int")
    cohorts = spark.createDataFrame(
        COHORTS,
        "MeasureID int, QuarterID int, IsActive int, CoveredDataStartDate string, CoveredDataEndDate string",
    )
    return periods(measures, cohorts)


def test_periods(table):
    rows = [tuple(r) for r in table.collect()]
    assert [r[4] for r in rows] == [1, 2, 3, 13]
    assert rows[0] == ("Current", MEASURES[0][1], D(2000, 7, 1), D(2001, 6, 30), 1)
    assert rows[3] == ("Previous", MEASURES[0][1], D(2000, 4, 1), D(2001, 3, 31), 13)


def test_windows(table):
    stored = window_bounds(report_windows(table))
    assert stored["abc_start"] == D(2000, 7, 1) and stored["exit4q_end"] == D(1999, 12, 31)
    quarter = window_bounds(report_windows(table, "cq"))
    assert quarter["abc_start"] == D(2001, 4, 1) and quarter["abc_end"] == D(2001, 6, 30)
    # 30 May + 1 day - 3 months clamps to the end of February
    assert quarter["exit2q_start"] == D(2001, 2, 28)
    assert window_bounds(report_windows(table, "ptd"))["exit4q_start"] == D(2016, 7, 1)
    assert window_bounds(report_windows(table, "other")) == stored


def test_missing_period_is_an_error(table):
    with pytest.raises(ValueError, match="Fourth Quarter"):
        window_bounds(report_windows(table.where("measure NOT LIKE '%Fourth%'")))


def test_first_period_in_sequence_wins(spark, table):
    extra = table.where("sequence = 1").selectExpr(
        "period", "measure", "DATE '1980-01-01' AS start", "end", "0 AS sequence"
    )
    assert window_bounds(report_windows(table.unionByName(extra)))["abc_start"] == D(1980, 1, 1)
