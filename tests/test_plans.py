"""What the physical plans must look like for large inputs."""

import re

import pytest

from tallyframe import CohortReport, standard_catalog
from tallyframe.operators import count_levels, exact_medians, listed_subset, prepare_input
from tallyframe.plans.catalog import COUNT, MEDIAN, REFINE
from tallyframe.sources import write_prepared
from testbed.queries import BOUNDS, conditions


@pytest.fixture(scope="module")
def stored(spark, make_raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "prepared")
    rows = [
        {"p918": "1", "p923": "00", "p901": "19990801", "p1704": str(i), "p3000": "AK"} for i in range(200)
    ]
    write_prepared(prepare_input(make_raw(rows)), path)
    return spark.read.parquet(path)


def executed(frame):
    frame.collect()
    text = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    return text.split("== Initial Plan ==")[0] if "== Initial Plan ==" in text else text


def test_counts_scan_once_and_shuffle_groups_only(stored):
    plan = executed(count_levels(stored, conditions("F04", "F26", "H16"), listed_subset()))
    assert plan.count("FileScan") == 1
    assert "partial_count" in plan
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Join", plan)


def test_medians_scan_once_with_pushed_filters(stored):
    frame = exact_medians(stored, conditions("G29", "I29", "K29", "M29"), "p1704", listed_subset())
    plan = executed(frame)
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|collect_list|percentile", plan)
    detail = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    pushed = re.findall(r"PushedFilters: \[(.*)\]", detail)[0]
    for part in ("EqualTo(p918,1)", "GreaterThanOrEqual(p901,1999-07-01)", "LessThanOrEqual(p901,2000-06-30)", "EqualTo(p923,0)"):
        assert part in pushed
    columns = re.findall(r"ReadSchema: struct<([^>]*)>", detail)[0]
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "p301", "p401", "p413", "p901", "p918", "p923", "p1704", "p3000",
    }


def test_full_report_reads_the_input_twice(stored):
    run = CohortReport(stored, standard_catalog(), BOUNDS, mode="both")
    plan = executed(run.results())
    assert plan.count("FileScan") == 2  # every counter in one pass, the medians in a pruned one
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python", plan)


def test_equal_conditions_are_counted_once(stored):
    catalog = standard_catalog()
    run = CohortReport(stored, catalog, BOUNDS, cells=catalog.names(COUNT, REFINE, MEDIAN))
    assert len(run.cells) == 171 and len(run._counters) < 125 and len(run._middles) == 4


def test_dry_run_starts_no_job(stored):
    tracker = stored.sparkSession.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    run = CohortReport(stored, standard_catalog(), BOUNDS, mode="both")
    run.results()
    run.catalog.resolved_frame(stored.sparkSession, BOUNDS)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_picked_buckets_are_broadcast_only_within_a_known_bound(stored):
    def plan(**options):
        texts = conditions("G29")
        frame = exact_medians(stored, texts, "p1704", listed_subset(codes=["AK"]), **options)
        return frame._jdf.queryExecution().sparkPlan().toString()

    stored.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan()
        assert "BroadcastHashJoin" in plan(max_subsets=1)
        assert "BroadcastHashJoin" in plan(by_subset=False)
        assert "BroadcastHashJoin" not in plan(max_subsets=10**6)
    finally:
        stored.sparkSession.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_static_list_reaches_the_scan(stored):
    run = CohortReport(stored, standard_catalog(), BOUNDS, mode="subsets", subsets=["AK", "AL"])
    for frame in (run._wide_counts(), run._wide_medians()):
        detail = frame._jdf.queryExecution().explainString(
            frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        assert "In(p3000, [AK,AL])" in re.findall(r"PushedFilters: \[(.*)\]", detail)[0]
