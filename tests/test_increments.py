"""Counts and medians from state per load: equal to one run over everything."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyframe import CohortReport, standard_catalog
from tallyframe.operators import State
from test_report import BOUNDS

MODES = [("default", ["AK", "ZZ"]), ("subsets", None), ("national", None), ("both", None)]
CELLS = ["F04", "F05", "F10", "H16", "G28", "G29", "I29", "K29", "M29", "G05n", "G05", "M32", "nope"]


def rows_of(n, shift=0):
    return [
        {
            "p918": str(1 + i % 2), "p900": f"{2000 + i % 2}0{1 + i % 9}11", "p901": f"{1999 + i % 3}0{1 + i % 8}20" if i % 4 else None, "p923": "00",
            "p1704": str((i * 37 + shift) % 900 - 50 + (0.25 if i % 5 else 0)) if i % 7 else None, "p1602": str(i % 9), "p3000": ["AK", "AL", None, "CA", "long"][i % 5],
        }
        for i in range(n)
    ]


def found(run):
    return sorted(map(str, run.results().collect()))


@pytest.mark.parametrize("mode,subsets", MODES)
def test_loads_add_up(spark, make_input, tmp_path, mode, subsets):
    first, second, odd = make_input(rows_of(300)), make_input(rows_of(170, 5)), make_input(rows_of(40, 9))
    options = {"mode": mode, "subsets": subsets, "cells": CELLS, "national_medians": mode == "subsets"}
    state = State(spark, str(tmp_path / "state"))
    run = lambda data, **more: CohortReport(data, standard_catalog(), BOUNDS, **options, **more)
    run(odd).save_state(state, F.lit("b"))  # replaced below
    run(first).save_state(state, F.lit("a"))
    run(second).save_state(state, F.lit("b"))
    nothing = first.limit(0)
    assert found(run(nothing, state=state)) == found(run(first.unionByName(second)))


def test_many_loads_of_one_scan_with_all_cells(spark, make_input, tmp_path):
    data = make_input(rows_of(400))
    state = State(spark, str(tmp_path / "state"))
    run = CohortReport(data, standard_catalog(), BOUNDS, mode="both")
    run.save_state(state, F.year("p900"))
    assert {r["load"] for r in state.table("counts").select("load").distinct().collect()} == {"2000", "2001"}
    assert found(CohortReport(data.limit(0), standard_catalog(), BOUNDS, mode="both", state=state)) == found(run)


def test_missing_state_is_an_error(spark, make_input, tmp_path):
    data, state = make_input(rows_of(20)), State(spark, str(tmp_path / "state"))
    run = lambda cells, bounds=BOUNDS, **more: CohortReport(data, standard_catalog(), bounds, cells=cells, **more)
    run(["F04", "G29"]).save_state(state, F.lit("a"))
    run(["F04"]).save_state(state, F.lit("b"))
    assert run(["F04"], state=state).results().count() > 0
    with pytest.raises(KeyError):
        run(["G29"], state=state)
    with pytest.raises(KeyError):  # another window is another condition
        run(["F04"], {**BOUNDS, "abc_end": dt.date(2009, 1, 1)}, state=state)
    with pytest.raises(KeyError):  # and another list of subsets another key
        run(["F04"], state=state, subsets=["AK"])


def test_vanished_values_and_empty_tables(spark, make_input, tmp_path):
    state = State(spark, str(tmp_path / "state"))
    run = lambda rows, **more: CohortReport(make_input(rows), standard_catalog(), BOUNDS, mode="both", cells=["G29", "F04"], **more)
    run(rows_of(60)).save_state(state, F.lit("a"))
    bare = [r | {"p1704": None} for r in rows_of(60)]
    run(bare).save_state(state, F.lit("a"))
    assert found(run([], state=state)) == found(run(bare))
    empty = State(spark, str(tmp_path / "none"))
    run([]).save_state(empty, F.lit("a"))
    assert found(run([], state=empty)) == found(run([]))


def test_medians_read_only_octaves_that_hold_their_ranks(spark, make_input, tmp_path):
    state = State(spark, str(tmp_path / "state"))
    data = make_input(rows_of(300))
    CohortReport(data, standard_catalog(), BOUNDS, mode="both", cells=["G29"]).save_state(state, F.lit("a"))
    run = CohortReport(data.limit(0), standard_catalog(), BOUNDS, mode="both", cells=["G29"], state=state)
    plan = run._wide_medians()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
