"""Queries over the test tables, one per operator of the engine."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import Catalog, Cell, CohortReport, standard_catalog
from tallyframe.functions import ratio_status, safe_ratio
from tallyframe.operators import (
    State,
    count_levels,
    exact_medians,
    listed_subset,
    long_counts,
    periods,
    prepare_input,
    report_windows,
    subset_list,
    window_bounds,
    window_table,
)
from tallyframe.plans import adhoc_sql, bind, window_report
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, REFINE
from tallyframe.sources import csv_to_parquet, parse_definitions, parse_expected, reference_rows
from tallyframe.sources.readers import COHORTS_SCHEMA, subset_codes, typed_reference
from testbed.participants import cohorts, measures, participants, participants_raw, read_table

BOUNDS = {
    "abc_start": dt.date(2000, 7, 1),
    "abc_end": dt.date(2001, 6, 30),
    "exit2q_start": dt.date(1999, 7, 1),
    "exit2q_end": dt.date(2000, 6, 30),
    "exit4q_start": dt.date(1999, 1, 1),
    "exit4q_end": dt.date(1999, 12, 31),
}

# a static list with codes the data holds and one it does not
LISTED = ["NA", "NB", "NC", "ND", "ZZ"]

PREDICATES = {
    "pred_eq": {"p918": "p918 = 1", "p202": "p202 = 1", "p923": "p923 = 00"},
    "pred_in": {"p808": "p808 IN (1, 2, 3, 4, 5)", "p401": "p401 IN (1, 2, 3, 5)"},
    "pred_range": {
        "date_to": "p900 <= :abc_end",
        "date_from": "p1101 >= :abc_start",
        "number": "p301 > 0",
    },
    "pred_date_window": {
        "exit2q": "p901 >= :exit2q_start AND p901 <= :exit2q_end",
        "exit4q": "p901 >= :exit4q_start AND p901 <= :exit4q_end",
    },
    "pred_num_window": {
        "closed": "p1602 >= 1 AND p1602 <= 8",
        "open": "p1704 > 0 AND p1704 < 999999.99",
    },
    "pred_null": {"null": "p901 IS NULL", "set": "p1102 IS NOT NULL"},
    "pred_active_window": {
        "active": "p900 <= :abc_end AND (p901 >= :abc_start OR p901 IS NULL)"
    },
    "pred_or_nested": {
        "trained": "p918 = 1 AND (p1000 IS NOT NULL OR p1001 IS NOT NULL)",
        "contacted": "p918 = 2 AND p301 > 0 AND (p1002 >= :abc_start OR p1007 >= :abc_start)",
    },
    "pred_or_top": {
        "either": "(p918 = 1 AND p900 <= :abc_end) OR (p918 = 2 AND p1002 >= :abc_start)"
    },
    "pred_constant": {"never": "923 = 00"},
}

REFINEMENTS = {
    "refine_chain_1": ["F04", "H16", "J12"],
    "refine_chain_2": ["F05", "F12", "H17"],
    "refine_chain_3": ["L05", "K12n", "M05n"],
}

MEDIANS = ["G29", "I29", "K29", "M29"]


def report(spark, sf_dir, mode="both", cells=None, catalog=None, **options) -> CohortReport:
    return CohortReport(
        participants(spark, sf_dir),
        standard_catalog() if catalog is None else catalog,
        BOUNDS,
        mode=mode,
        cells=cells,
        **options,
    )


def numbers(run: CohortReport, *extra: str) -> DataFrame:
    return run.results().select("cell", "subset", "value", *extra)


def counted(frame: DataFrame) -> DataFrame:
    """Wide counts of ``count_levels`` as ``(cell, subset, n)``."""
    names = [c for c in frame.columns if c not in ("national", "subset")]
    return long_counts(frame, names).select("cell", "subset", "n")


def conditions(*cells: str) -> dict[str, str]:
    catalog = standard_catalog()
    return {c: bind(catalog.resolve(c).predicate, BOUNDS) for c in cells}


# --- sources and preparation ----------------------------------------------------


def scan_input(spark, sf_dir):
    return participants_raw(spark, sf_dir)


def prepared_input(spark, sf_dir):
    data = participants(spark, sf_dir)
    return data.withColumn("p1704", F.col("p1704").cast("double"))


def converted_input(spark, sf_dir):
    """Raw records through CSV and clustered Parquet, then prepared: the same rows."""
    folder = kept_folder(spark)
    participants_raw(spark, sf_dir).write.option("header", True).csv(f"{folder}/csv")
    csv_to_parquet(spark, f"{folder}/csv", f"{folder}/parquet", header=True, cluster_by=["PIRL3000", "PIRL901"], part_bytes=16 << 20)
    data = prepare_input(spark.read.parquet(f"{folder}/parquet"))
    return data.withColumn("p1704", F.col("p1704").cast("double"))


def input_count(spark, sf_dir):
    return participants(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows"))


def subsets(spark, sf_dir):
    return subset_list(participants(spark, sf_dir)).orderBy("subset")


def typed_cohorts(spark, sf_dir):
    """Cohorts as a CSV file gives them, all text: whole numbers, decimals and junk, from orders."""
    text = read_table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS QuarterID",
        "CASE o_custkey % 3 WHEN 0 THEN concat(o_custkey, '.0') WHEN 1 THEN CAST(o_custkey AS STRING) ELSE 'none' END AS MeasureID",
        "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' END AS IsActive",
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 00:00:00') AS CoveredDataStartDate",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS CoveredDataEndDate",
    )
    return typed_reference(text, COHORTS_SCHEMA)


def cohort_texts(spark, sf_dir):
    """Text lines of cohorts from orders: good ones, a decimal, junk, blanks, and a missing number."""
    return read_table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE CAST(o_orderkey AS STRING) END AS QuarterID",
        "CASE o_custkey % 5 WHEN 0 THEN concat(o_custkey, '.0') WHEN 1 THEN 'none' WHEN 2 THEN '' ELSE CAST(o_custkey AS STRING) END AS MeasureID",
        "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '0' ELSE o_orderstatus END AS IsActive",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS CoveredDataStartDate",
        "CAST(NULL AS STRING) AS CoveredDataEndDate",
    )


def rejected_lines(spark, sf_dir):
    """Rejected cohort lines by reason beside the rows kept."""
    rows, rejects = reference_rows(cohort_texts(spark, sf_dir), COHORTS_SCHEMA, "cohorts", required=["QuarterID"])
    kept = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("MeasureID").alias("ids")).select(F.lit("kept").alias("reason"), "n", "ids")
    return kept.unionByName(rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("line").alias("ids")))


def static_subsets(spark, sf_dir):
    """A static list's line made of all nations; later lines don't count."""
    line = read_table(spark, sf_dir, "nation").agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit(" "), F.upper(F.substring("n_name", 1, 2)), F.col("n_nationkey").cast("string")))), ","))
    return subset_codes(line.toDF("value"))


def prepare_odd_forms(spark, sf_dir):
    """Dates as whole numbers, codes as decimals, both as they come from other exports."""
    raw = read_table(spark, sf_dir, "orders").selectExpr(
        "CAST(date_format(o_orderdate, 'yyyyMMdd') AS INT) AS PIRL900",
        "CASE o_custkey % 4 WHEN 0 THEN concat(o_custkey, '.0') WHEN 1 THEN concat(o_custkey, '.9') WHEN 2 THEN concat('0', o_custkey) ELSE 'x' END AS PIRL918",
        "CAST(o_totalprice AS STRING) AS PIRL1704",
        "CAST(o_orderkey AS STRING) AS PIRL3000",
    )
    ready = prepare_input(raw, kept=["PIRL900", "PIRL918", "PIRL1704", "PIRL3000"])
    return ready.withColumn("p1704", F.col("p1704").cast("double"))


def expected_values(spark, sf_dir):
    """Every order as a line of an expected-values file, in all the forms such lines take."""
    lines = read_table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderpriority "
        "WHEN '1-URGENT' THEN concat('C', o_orderkey, '-NA = ', o_custkey) "
        "WHEN '2-HIGH' THEN concat('  C', o_orderkey, '-ALL = ', o_custkey, ' ') "
        "WHEN '3-MEDIUM' THEN concat('C', o_orderkey, ' = ', o_custkey) "
        "WHEN '4-NOT SPECIFIED' THEN concat('C', o_orderkey, '-NB') "
        "ELSE CASE o_orderstatus WHEN 'F' THEN '   ' ELSE concat('// C', o_orderkey, '-NA = 1') END "
        "END AS value"
    )
    return parse_expected(lines)


def cell_catalog(spark, sf_dir):
    """Every part as a cell definition, in all the forms definitions take."""
    definitions = read_table(spark, sf_dir, "part").selectExpr(
        "concat('P', p_partkey) AS id",
        "element_at(array('count', 'median', 'formula-concatenator', 'formula-division'), "
        "CAST(p_partkey % 4 + 1 AS INT)) AS type",
        "CASE CAST(p_partkey % 4 AS INT) "
        "WHEN 0 THEN concat('_scfIw_ p202 = ', p_size, ' AND p901 _inn_') "
        "WHEN 1 THEN concat('_swfIw_ p301 > ', p_size, ' AND p901 >= _begExit2q_') "
        "WHEN 2 THEN concat('P', p_partkey - 1, ' :: AND ( p413 = ', p_size, ' OR p900 _in_ )') "
        "ELSE concat('P', p_partkey - 3, '/P', p_partkey - 1) END AS query",
    )
    return parse_definitions(definitions).select(
        "cell", "kind", "parent", "predicate", "value", "num", "den"
    )


# --- periods --------------------------------------------------------------------


def period_table(spark, sf_dir, quarter=13):
    return periods(measures(spark), cohorts(spark, sf_dir), quarter)


def window_query(window: str):
    def run(spark, sf_dir):
        return report_windows(period_table(spark, sf_dir), window)

    return run


# --- counts ---------------------------------------------------------------------


def count_national(spark, sf_dir):
    return numbers(report(spark, sf_dir, "national", ["F04", "F16", "H11", "J10", "L31"]))


def count_by_subset(spark, sf_dir):
    wide = count_levels(participants(spark, sf_dir), conditions("F04"), listed_subset())
    return counted(wide.where("NOT national AND F04 > 0")).select("subset", "n").orderBy("subset")


def count_zero_fill(spark, sf_dir):
    wide = count_levels(
        participants(spark, sf_dir), conditions("F04", "F26", "L31"), listed_subset(codes=LISTED), LISTED, "listed"
    )
    return counted(wide.where("NOT national"))


def count_rollup(total: str):
    def run(spark, sf_dir):
        data, key = participants(spark, sf_dir), listed_subset()
        return counted(count_levels(data, conditions("F04", "F10", "H04"), key, total=total))

    return run


def predicate_query(name: str):
    def run(spark, sf_dir):
        texts = {k: bind(v, BOUNDS) for k, v in PREDICATES[name].items()}
        return counted(count_levels(participants(spark, sf_dir), texts, listed_subset()))

    return run


def refine_query(name: str):
    def run(spark, sf_dir):
        return numbers(report(spark, sf_dir, "both", REFINEMENTS[name]))

    return run


def refine_or_precedence(spark, sf_dir):
    texts = {
        "textual": bind(standard_catalog().resolve("F12").predicate, BOUNDS),
        "wrapped": bind(standard_catalog(wrap=True).resolve("F12").predicate, BOUNDS),
    }
    return counted(count_levels(participants(spark, sf_dir), texts, listed_subset()))


# --- medians --------------------------------------------------------------------


def medians(national: bool, by_subset: bool):
    def run(spark, sf_dir):
        rows = exact_medians(
            participants(spark, sf_dir), conditions(*MEDIANS), "p1704", listed_subset(), national, by_subset
        )
        return rows.select("cell", "subset", F.col("median").cast("double").alias("median"))

    return run


def median_by_subset(spark, sf_dir):
    return numbers(report(spark, sf_dir, "subsets", MEDIANS, subsets=LISTED), "status")


# --- fused, ratios, statuses ------------------------------------------------------


def fused_cells(spark, sf_dir):
    catalog = standard_catalog()
    return numbers(report(spark, sf_dir, "both", catalog.names(COUNT, REFINE, MEDIAN)))


def resolved_catalog(spark, sf_dir):
    """Where each cell's filter comes from and how many rows it selects."""
    run = report(spark, sf_dir, "national", standard_catalog().names(COUNT, REFINE))
    resolved = run.catalog.resolved_frame(spark, BOUNDS).select("ordinal", "cell", "root", "depth")
    return numbers(run).join(resolved, "cell").select(
        "ordinal", "cell", "root", "depth", F.col("value").cast("bigint").alias("n")
    )


RATIO_CELLS = ["F04", "H04", "G05n", "G05", "L31", "L30", "M32", "I05p", "I05"]


def ratio_query(mode: str):
    def run(spark, sf_dir):
        run = report(spark, sf_dir, mode, RATIO_CELLS)
        ratios = F.col("cell").isin([c.name for c in run.cells if c.kind == RATIO])
        return numbers(run, "numerator", "denominator", "status").where(ratios)

    return run


def ratio_status_query(spark, sf_dir):
    """A ratio whose operand was not run, and one with a zero denominator."""
    run = report(spark, sf_dir, "both", ["F04", "G05", "G05n", "L31", "L30", "M32"])
    return numbers(run, "status").where("cell IN ('G05', 'M32')")


STATUS_CATALOG = [
    Cell("ok", COUNT, predicate="p918 = 1"),
    Cell("bad", COUNT, predicate="no_such_column = 1"),
    Cell("never", COUNT, predicate="p918 = 3"),
    Cell("orphan", REFINE, parent="nobody", predicate="p918 = 1"),
    Cell("middle", MEDIAN, predicate="p918 = 1 AND p1704 > 0"),
    Cell("empty", MEDIAN, predicate="p918 = 3"),
    Cell("zero", RATIO, num="ok", den="never"),
    Cell("broken", RATIO, num="ok", den="bad"),
    Cell("half", RATIO, num="ok", den="ok"),
    Cell("unset", RATIO, num="empty", den="ok"),
]

# conditions that fail before they run, each beside the good cells
CONTAINED = {
    "aggregate": "count(*) > 1",
    "window": "row_number() over (order by p918) > 1",
    "generator": "explode(array(true, false))",
    "parentheses": "p918 = 1) OR (p918 = 2",
    "regex": "p3000 rlike '('",
    "raised": "raise_error('no') = 1",
    "pattern": "to_date(p3000, 'qqqqq') is null",
    "position": "element_at(array(1), 0) = p918",
    "random": "rand() > 2",
    "data_regex": "p3000 rlike p3000",
}

# conditions that look like them and run
HARMLESS = {
    "comment": "p918 = 1 -- note",
    "code_as_number": "p3000 = 1",
    "date_as_text": "p900 >= 'junk'",
    "division": "1/(p918-1) > 0",
    "good_regex": "p3000 rlike '^N[A-C]$'",
}


def cell_status(spark, sf_dir):
    cells = [*STATUS_CATALOG, *[Cell(n, COUNT, predicate=c) for n, c in (CONTAINED | HARMLESS).items()], Cell("regex_median", MEDIAN, predicate=CONTAINED["regex"])]
    return cell_statuses(spark, sf_dir, cells)


def cell_statuses(spark, sf_dir, cells):
    names = [c.name for c in cells] + ["unknown"]
    return numbers(report(spark, sf_dir, "both", names, Catalog(cells)), "status")


def safe_ratios(spark, sf_dir):
    """Returned share of quantity per supplier and line status, some without any quantity."""
    returned = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")))
    flown = F.sum(F.when(F.col("l_linestatus") == "F", 1).otherwise(0))
    grouped = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_returnflag")
        .agg(returned.cast("bigint").alias("num"), (flown * F.pmod(F.col("l_suppkey"), F.lit(3))).alias("den"))
    )
    num, den = F.col("num"), F.col("den")
    return grouped.select(
        "l_suppkey", "l_returnflag", safe_ratio(num, den).alias("ratio"), ratio_status(num, den).alias("status")
    )


# --- reconciliation ---------------------------------------------------------------

COMPARED = ["F04", "F16", "F04p", "L31"]


def expected_frame(spark, sf_dir):
    """Expected counts as text lines: right, off by one, empty or absent by subset."""
    tallies = counted(
        count_levels(participants(spark, sf_dir), conditions(*COMPARED), listed_subset())
    )
    lines = tallies.selectExpr(
        "CASE ascii(substr(subset, 2, 1)) % 4 "
        "WHEN 0 THEN concat(cell, '-', subset, ' = ', n) "
        "WHEN 1 THEN concat(cell, '-', subset, ' = ', n + 1) "
        "WHEN 2 THEN concat(cell, '-', subset) "
        "ELSE '// not known' END AS value"
    )
    return parse_expected(lines)


def compare_expected_query(spark, sf_dir):
    return report(spark, sf_dir, "both", COMPARED).compare(expected_frame(spark, sf_dir))


def report_rows_query(spark, sf_dir):
    return report(spark, sf_dir, "both", COMPARED).report(expected_frame(spark, sf_dir))


def accuracy_query(spark, sf_dir):
    return report(spark, sf_dir, "both", COMPARED).accuracy(expected_frame(spark, sf_dir))


def reconcile_all(spark, sf_dir):
    """All 252 cells against expected lines: the number in another writing, as it is, wrong, empty, absent, and twice with different values."""
    run = report(spark, sf_dir, "both")
    lines = run.results().selectExpr(
        "explode(CASE (ascii(substr(subset, 2, 1)) + ascii(substr(cell, 3, 1))) % 6 "
        "WHEN 0 THEN array(concat(cell, '-', subset, ' = ', CASE WHEN status = 'OK' THEN '+' ELSE '' END, actual)) "
        "WHEN 1 THEN array(concat(cell, '-', subset, ' = ', actual)) "
        "WHEN 2 THEN array(concat(cell, '-', subset, ' = x', actual)) "
        "WHEN 3 THEN array(concat(cell, '-', subset)) "
        "WHEN 4 THEN array('// not known') "
        "ELSE array(concat(cell, '-', subset, ' = ', actual), concat(cell, '-', subset, ' = zzz')) END) AS value"
    )
    compared = run.compare(parse_expected(lines), by_number=True)
    number = lambda c: F.col(c).try_cast("double").alias(c)
    return compared.select(
        "cell", "subset",
        F.when(F.col("cell").isin(MEDIANS), F.col("value").try_cast("float").cast("double")).otherwise(F.col("value").try_cast("double")).alias("value"),
        number("numerator"), number("denominator"), "match", "outcome",
        F.when(F.col("actual").isin("a/0", "undefined"), F.col("actual")).alias("status"),
    )


# --- run control ------------------------------------------------------------------


def run_selection(spark, sf_dir):
    return numbers(report(spark, sf_dir, "default", ["F05", "G05", "F04", "nope", "G29"]), "status")


def report_both_modes(spark, sf_dir):
    return numbers(report(spark, sf_dir, "both", BOTH_MODES))


def kept_folder(spark) -> str:
    """A new folder in the one that driver and executors share; a local one only where none is set, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="tallyframe-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


BOTH_MODES = ["F04", "F10", "H16", "G05n", "G05", "G29"]


def report_from_loads(spark, sf_dir):
    """The report from state kept per load (year of entry); the loads of one year are kept twice and count once."""
    state, year = State(spark, kept_folder(spark)), F.year("p900")
    run = report(spark, sf_dir, "both", BOTH_MODES)
    run.save_state(state, year)
    again = CohortReport(run.data.where(year == 1995), standard_catalog(), BOUNDS, mode="both", cells=BOTH_MODES)
    again.save_state(state, year)
    return numbers(report(spark, sf_dir, "both", BOTH_MODES, state=state))


def run_stats(spark, sf_dir):
    return report(spark, sf_dir).run_stats()


ADHOC = (
    "SELECT p3000 AS subset, count(*) AS n, max(p900) AS latest FROM {input} "
    "WHERE p918 = 1 AND p901 IS NULL GROUP BY p3000 ORDER BY n DESC, subset NULLS LAST"
)


def adhoc(spark, sf_dir):
    participants(spark, sf_dir).createOrReplaceTempView("input")
    return adhoc_sql(spark, ADHOC.format(input="input"), 10)


def full_report(spark, sf_dir):
    """The whole standard report, with its windows derived from the reference tables."""
    bounds = window_bounds(report_windows(period_table(spark, sf_dir)))
    run = CohortReport(participants(spark, sf_dir), standard_catalog(), bounds, mode="both")
    return numbers(run, "numerator", "denominator", "status")


WINDOWED = ["F04p", "F04", "F05", "F10", "F12", "F27", "F31", "F26", "G28", "G05n", "G05"]


def window_grid(spark, sf_dir):
    """Three windows of two quarters from one scan."""
    bounds = window_table(measures(spark), cohorts(spark, sf_dir), quarters=(12, 13))
    return window_report(participants(spark, sf_dir), standard_catalog(), bounds, WINDOWED)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "full_report": full_report,
    "scan_input": scan_input,
    "prepare_input": prepared_input,
    "converted_input": converted_input,
    "input_count": input_count,
    "subset_list": subsets,
    "expected_values": expected_values,
    "typed_cohorts": typed_cohorts,
    "rejected_lines": rejected_lines,
    "static_subsets": static_subsets,
    "prepare_odd_forms": prepare_odd_forms,
    "cell_catalog": cell_catalog,
    "periods": period_table,
    **{f"report_window_{w}": window_query(w) for w in ("r4q", "cq", "ptd")},
    **{name: predicate_query(name) for name in PREDICATES},
    **{name: refine_query(name) for name in REFINEMENTS},
    "refine_or_precedence": refine_or_precedence,
    "count_national": count_national,
    "count_by_subset": count_by_subset,
    "count_zero_fill": count_zero_fill,
    "count_rollup_listed": count_rollup("listed"),
    "count_rollup_all": count_rollup("all"),
    "median_national": medians(True, False),
    "median_by_subset": median_by_subset,
    "median_rollup": medians(True, True),
    "fused_cells": fused_cells,
    "resolved_catalog": resolved_catalog,
    "ratio_national": ratio_query("national"),
    "ratio_by_subset": ratio_query("subsets"),
    "ratio_status": ratio_status_query,
    "safe_ratio": safe_ratios,
    "cell_status": cell_status,
    "compare_expected": compare_expected_query,
    "report_rows": report_rows_query,
    "accuracy_summary": accuracy_query,
    "reconcile_all": reconcile_all,
    "run_selection": run_selection,
    "report_both_modes": report_both_modes,
    "report_from_loads": report_from_loads,
    "run_stats": run_stats,
    "adhoc_sql": adhoc,
    "window_grid": window_grid,
}
