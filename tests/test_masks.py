"""Counts through bit masks equal counters of their own."""

import random

from pyspark.sql import functions as F

from tallyframe import Catalog, Cell, CohortReport
from tallyframe.operators.conditions import analyze
from tallyframe.operators.counts import group_counts
from tallyframe.operators.masks import WIDTH, _atoms, mask_counts
from tallyframe.plans.catalog import COUNT, REFINE


def random_condition(rng, depth=3):
    if depth == 0 or rng.random() < 0.2:
        column = rng.choice("abc")
        return rng.choice([f"{column} = {rng.randrange(4)}", f"{column} IS NULL", f"NOT ({column} > {rng.randrange(4)})", f"{column} IN (1, {rng.randrange(4)})", f"k = 'x{rng.randrange(4)}'", "a = NULL", "true", "k = 1"])
    parts = [random_condition(rng, depth - 1) for _ in range(2)]
    return f"({parts[0]}) {rng.choice(['AND', 'OR'])} ({parts[1]})" if rng.random() < 0.6 else f"{parts[0]} {rng.choice(['AND', 'OR'])} {parts[1]}"


def test_masks_equal_counters(spark):
    rng = random.Random(4)
    value = lambda: rng.choice([None, 0, 1, 2, 3])
    data = spark.createDataFrame([(value(), value(), value(), rng.choice([None, "x1", "x2"])) for _ in range(400)], "a int, b int, c int, k string")
    many = [f"a + b = {i}" for i in range(WIDTH + 20)]  # more atoms than one mask holds
    odd = ["a between 1 and 2 AND b = 1", "k like 'x%' OR a = 1", "cast(k as int) = 1 AND a = 1", "a = 1 -- note", "exists(array(a, b), v -> v = 1) AND c = 1", "`a` = 1 AND k = 'it\\'s'"]
    conditions = {f"n{i}": text for i, text in enumerate([*(random_condition(rng) for _ in range(80)), *many, " OR ".join(many), *odd])}
    analysis = analyze(data, conditions.values())
    assert [t for t, c in analysis.items() if c is None] == []
    assert len(set().union(*(_atoms(c.tree) for c in analysis.values()))) > WIDTH
    rows = lambda frame: sorted(map(tuple, frame.collect()), key=str)
    assert rows(mask_counts(data, conditions, analysis, F.col("k"))) == rows(group_counts(data, conditions, F.col("k")))
    assert rows(mask_counts(data, conditions, analysis)) == rows(group_counts(data, conditions))


def test_each_test_is_evaluated_once_a_row(spark):
    """A family of refinements repeats its parent's tests; the plan over the rows has them once, below the counters."""
    data = spark.createDataFrame([(1, 2, "AK"), (2, 3, "AL")], "a int, b int, p3000 string")
    cells = [Cell("root", COUNT, predicate="a = 1 AND b > 1")]
    cells += [Cell(f"c{i}", REFINE, parent="root" if i % 2 else f"c{i - 1}" if i else "root", predicate=f"b < {i}") for i in range(30)]
    run = CohortReport(data, Catalog(cells), mode="national")
    plan = run._wide_counts()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" = 1)") == 1 and plan.count("> 1)") == 1 and plan.count("mask0") > 20
    got = {r["cell"]: int(r["value"]) for r in run.results().collect()}
    assert got["root"] == 1 and got["c29"] == 1 and got["c1"] == 0
