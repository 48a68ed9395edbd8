"""A report run: every selected cell for every subset and the nation."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions import ratio_status, safe_ratio
from tallyframe.functions.local import local_table
from tallyframe.operators.conditions import analyze
from tallyframe.operators.counts import (
    LEVEL,
    count_levels,
    group_counts,
    spread_levels,
    zero_rows,
)
from tallyframe.operators.increments import State, count_state, digest, median_state
from tallyframe.operators.masks import mask_counts
from tallyframe.operators.medians import exact_medians
from tallyframe.operators.reconcile import accuracy_summary, compare_expected, report_rows
from tallyframe.operators.subsets import STANDARD, code_length, is_listed, listed_subset, subset_list
from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, Catalog, ResolvedCell, bind
from tallyframe.plans.containment import failing_conditions


@dataclass(frozen=True)
class Mode:
    """Which levels each kind of cell is reported on, and what the nation adds up."""

    levels: Mapping[str, tuple[bool, bool]]  # kind -> (national, by subset)
    total: str


MODES = {
    # counts by subset with their sum, everything else for the nation only
    "default": Mode({COUNT: (True, True), MEDIAN: (True, False), RATIO: (True, False)}, "listed"),
    "subsets": Mode({COUNT: (True, True), MEDIAN: (False, True), RATIO: (False, True)}, "listed"),
    "national": Mode({k: (True, False) for k in (COUNT, MEDIAN, RATIO)}, "all"),
    "both": Mode({k: (True, True) for k in (COUNT, MEDIAN, RATIO)}, "all"),
}


#: Conditions from which on a run counts them through masks; a few are as fast on their own and need no further analysis.
MASKED_FROM = 12


def sql_string(text: str) -> str:
    """The text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number_text(number: Column, kind: Column) -> Column:
    """Number as text in the type of its cell: whole, single or double precision."""
    return (
        F.when(kind == COUNT, number.cast("bigint").cast("string"))
        .when(kind == MEDIAN, number.cast("float").cast("string"))
        .otherwise(number.cast("string"))
    )


class CohortReport:
    """Evaluates catalog cells over prepared input.

    data: prepared participant records
    bounds: values of the catalog's ``:name`` window bounds
    mode: ``default``, ``subsets``, ``national`` or ``both``
    subsets: codes to list; without it every code found that is at most ``max_code_length`` long
    max_code_length: two for the standard subset column, no bound for any other, unless given
    cells: names to run, in this order; without it the whole catalog
    national_medians: also report medians of the nation in mode ``subsets``
    contain: a condition that some row could make fail is ``FAILED`` before the run; without it only those that Spark rejects
    state: counts and medians come from these tables of ``save_state`` instead of ``data``, of which only the columns matter then
    """

    def __init__(
        self,
        data: DataFrame,
        catalog: Catalog,
        bounds: Mapping[str, dt.date] | None = None,
        mode: str = "default",
        subsets: Sequence[str] | None = None,
        subset_column: str = layout.SUBSET_COLUMN,
        cells: Iterable[str] | None = None,
        national_medians: bool = False,
        max_code_length: int | None = STANDARD,
        contain: bool = True,
        state: State | None = None,
    ):
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}, use one of {', '.join(MODES)}")
        if layout.NATIONAL in (subsets or ()):
            raise ValueError(f"{layout.NATIONAL} stands for the nation, it cannot be a subset")
        self.data = data
        self.spark = data.sparkSession
        self.catalog = catalog
        self.bounds = dict(bounds or {})
        self.mode = mode
        self.subsets = None if subsets is None else list(subsets)
        self.subset_column = subset_column
        self.max_code_length = max_code_length
        self.contain = contain
        self.levels = dict(MODES[mode].levels)
        self.total = MODES[mode].total
        if national_medians:
            self.levels[MEDIAN] = (True, self.levels[MEDIAN][1])
        self.cells = self._runnable(catalog.select(cells))
        self.state = state
        if state is not None:
            state.require(self._digests())

    def _runnable(self, cells: list[ResolvedCell]) -> list[ResolvedCell]:
        """Cells with bound conditions; one that Spark rejects or that may raise fails alone."""
        bound = []
        for cell in cells:
            if cell.predicate is not None:
                cell = replace(cell, predicate=bind(cell.predicate, self.bounds))
            bound.append(cell)
        self.analysis = analyze(self.data, [c.predicate for c in bound if c.predicate])
        bad = failing_conditions(self.spark, self.analysis, self.contain)
        missing = {
            c.value for c in bound if c.kind == MEDIAN and c.value not in self.data.columns
        }
        return [
            replace(c, kind=layout.FAILED, problem="no filter that can run beside others")
            if c.predicate in bad or (c.kind == MEDIAN and c.value in missing)
            else c
            for c in bound
        ]

    # --- evaluation -----------------------------------------------------------

    @cached_property
    def _counters(self) -> dict[str, str]:
        """Distinct count condition -> counter column; equal conditions are counted once."""
        texts = dict.fromkeys(c.predicate for c in self.cells if c.kind == COUNT)
        return {text: f"n{i}" for i, text in enumerate(texts)}

    @cached_property
    def _middles(self) -> dict[tuple[str, str], str]:
        """Distinct (value column, median condition) -> median column."""
        keys = dict.fromkeys((c.value, c.predicate) for c in self.cells if c.kind == MEDIAN)
        return {key: f"m{i}" for i, key in enumerate(keys)}

    def _key(self) -> Column:
        return listed_subset(self.subset_column, self.subsets, self.max_code_length)

    def _listed_rows(self) -> DataFrame:
        """Rows that count where only listed subsets do."""
        return self.data.where(is_listed(self.subset_column, self.subsets, self.max_code_length))

    def _grouped(self, data: DataFrame, conditions: Mapping[str, str], subset: Column | None = None) -> DataFrame:
        """Counters by subset, through masks where many conditions share their tests."""
        if self.state is not None:
            return self.state.grouped({c: self._digest(text) for c, text in conditions.items()}, subset is not None)
        return self._counted(data, conditions, subset)

    def _counted(self, data: DataFrame, conditions: Mapping[str, str], subset: Column | None = None) -> DataFrame:
        if len(conditions) < MASKED_FROM:
            return group_counts(data, conditions, subset)
        return mask_counts(data, conditions, self.analysis, subset)

    # --- state ------------------------------------------------------------------

    def _digest(self, condition: str, value: str | None = None) -> str:
        rule = [self.subset_column, self.subsets, code_length(self.subset_column, self.max_code_length)]
        return digest(condition, rule, value)

    def _digests(self) -> dict[str, str]:
        """Digest -> condition of every count and median of the run."""
        counts = {self._digest(text): text for text in self._counters}
        return counts | {self._digest(text, value): text for value, text in self._middles}

    def save_state(self, state: State, load: Column) -> None:
        """Keeps this run's counts and medians of every load in ``data``, to be summed by runs with ``state``.

        Loads that were kept before are replaced. Windows are part of a condition: runs need the same bounds.
        """
        counts = count_state(self.data, self._digests(), self._key(), load, self._counted)
        values = None
        by_value: dict[str, dict[str, str]] = {}
        for value, text in self._middles:
            by_value.setdefault(value, {})[self._digest(text, value)] = text
        for value, conditions in by_value.items():
            rows = median_state(self.data, conditions, value, self._key(), load)
            values = rows if values is None else values.unionByName(rows)
        state.save(counts, values)

    def _wide_counts(self) -> DataFrame:
        conditions = {column: text for text, column in self._counters.items()}
        if self.mode == "national":
            nation = zero_rows(self.spark, [])
            if not conditions:
                return nation
            # one row by construction, so the national label is a literal
            return self._grouped(self.data, conditions).select(
                F.lit(True).alias("national"), F.lit(layout.NATIONAL).alias("subset"), *conditions
            )
        if not conditions:
            if self.subsets is not None:
                return zero_rows(self.spark, [], self.subsets)
            found = spread_levels(subset_list(self.data, self.subset_column, self.max_code_length))
            return found.unionByName(zero_rows(self.spark, [])).distinct()
        data = self._listed_rows() if self.total == "listed" else self.data
        return count_levels(data, conditions, self._key(), self.subsets, self.total, grouped=self._grouped)

    def _wide_medians(self) -> DataFrame | None:
        """One row per level with a column per distinct median."""
        by_value: dict[str, dict[str, str]] = {}
        for (value, text), column in self._middles.items():
            by_value.setdefault(value, {})[column] = text
        national, by_subset = self.levels[MEDIAN]
        data = self.data if national else self._listed_rows()
        known = None if self.subsets is None else len(self.subsets)
        if self.state is not None and self._middles:
            digests = {column: self._digest(text, value) for (value, text), column in self._middles.items()}
            by_value, parts = {}, [self.state.medians(digests, national, by_subset)]
        else:
            parts = []
        parts += [
            exact_medians(data, conditions, value, self._key(), national, by_subset, known)
            for value, conditions in by_value.items()
        ]
        if not parts:
            return None
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        columns = list(self._middles.values())
        return rows.groupBy(*LEVEL).agg(
            *[F.max(F.when(F.col("cell") == c, F.col("median"))).alias(c) for c in columns]
        )

    @cached_property
    def _wide(self) -> DataFrame:
        """One row per level holding every distinct count and median."""
        counts, medians = self._wide_counts(), self._wide_medians()
        if medians is None:
            return counts
        # counts hold every level that is reported, medians only the non-empty ones
        return counts.join(medians, list(LEVEL), "left")

    @cached_property
    def _long(self) -> DataFrame:
        """Numbers per cell and level: a count, a median, or the two sides of a ratio."""
        # one SQL text instead of thousands of Column calls, which would dominate small runs
        nothing = "CAST(NULL AS DOUBLE)"
        values: dict[str, tuple[str, str]] = {}
        entries = []
        for cell in self.cells:
            (first, first_kind), (second, second_kind) = (nothing, ""), (nothing, "")
            if cell.kind == COUNT:
                first = f"CAST({self._counters[cell.predicate]} AS DOUBLE)"
                values[cell.name] = (first, COUNT)
            elif cell.kind == MEDIAN:
                first = f"CAST({self._middles[(cell.value, cell.predicate)]} AS DOUBLE)"
                values[cell.name] = (first, MEDIAN)
            elif cell.kind == RATIO:
                first, first_kind = values.get(cell.num, (nothing, ""))
                second, second_kind = values.get(cell.den, (nothing, ""))
                values[cell.name] = (f"try_divide({first}, {second})", RATIO)
            national, by_subset = self.levels.get(cell.kind, (True, False))
            entries.append(
                f"struct({sql_string(cell.name)} AS cell, '{cell.kind}' AS kind, "
                f"{first} AS first, {second} AS second, '{first_kind}' AS first_kind, "
                f"'{second_kind}' AS second_kind, {national} AS on_nation, {by_subset} AS on_subset)"
            )
        return (
            self._wide.selectExpr(*LEVEL, f"inline(array({', '.join(entries)}))")
            .where("CASE WHEN national THEN on_nation ELSE on_subset END")
            .drop("on_nation", "on_subset")
        )

    def results(self) -> DataFrame:
        """One row per cell and level: ``cell, subset, value, numerator, denominator, status``
        as numbers, and ``actual, numerator_text, denominator_text`` as reported."""
        kind, first, second = F.col("kind"), F.col("first"), F.col("second")
        is_ratio = kind == RATIO
        status = (
            F.when(is_ratio, ratio_status(first, second))
            .when(kind == MEDIAN, F.when(first.isNull(), layout.UNDEFINED).otherwise(layout.OK))
            .when(kind == COUNT, layout.OK)
            .otherwise(kind)
        )
        divided = is_ratio & first.isNotNull() & second.isNotNull()
        return (
            self._long.withColumn("status", status)
            .withColumn("value", F.when(is_ratio, safe_ratio(first, second)).otherwise(first))
            .select(
                "cell",
                "subset",
                "value",
                F.when(divided, first).alias("numerator"),
                F.when(divided, second).alias("denominator"),
                "status",
                F.when(F.col("status") == layout.OK, number_text(F.col("value"), kind))
                .otherwise(F.col("status"))
                .alias("actual"),
                F.when(divided, number_text(first, F.col("first_kind"))).alias("numerator_text"),
                F.when(divided, number_text(second, F.col("second_kind"))).alias("denominator_text"),
            )
        )

    # --- reporting ------------------------------------------------------------

    def queries(self) -> DataFrame:
        """Per run cell what it evaluates: ``(cell, kind, query)``."""
        rows = [
            (c.name, c.kind, f"{c.num}/{c.den}" if c.kind == RATIO else c.predicate or "")
            for c in self.cells
        ]
        return local_table(self.spark, rows, "cell string, kind string, query string")

    def compare(self, expected: DataFrame, by_number: bool = False) -> DataFrame:
        """Every result against its expected value, see ``operators.compare_expected``."""
        national, query = F.col("subset") == layout.NATIONAL, F.col("query")
        operands = F.split(query, "/")
        of_subset = (
            F.when(
                F.col("kind") == RATIO,
                F.concat(
                    F.get(operands, F.lit(0)), F.lit("-"), F.col("subset"), F.lit("/"),
                    F.get(operands, F.lit(1)), F.lit("-"), F.col("subset"),
                ),
            )
            .when(
                F.col("kind") == MEDIAN,
                F.concat(query, F.lit(f" AND {self.subset_column} = '"), F.col("subset"), F.lit("'")),
            )
            .otherwise(query)
        )
        shown = (
            self.results()
            .join(self.queries(), "cell", "left")
            .select(
                "cell",
                "subset",
                "kind",
                F.col("numerator_text").alias("numerator"),
                F.col("denominator_text").alias("denominator"),
                "actual",
                F.when(national, query).otherwise(of_subset).alias("query"),
            )
        )
        return compare_expected(shown, expected, by_number)

    def report(self, expected: DataFrame, by_number: bool = False) -> DataFrame:
        """The nine-column report in key order."""
        return report_rows(self.compare(expected, by_number))

    def accuracy(self, expected: DataFrame, by_number: bool = False) -> DataFrame:
        return accuracy_summary(self.compare(expected, by_number))

    def run_stats(self) -> DataFrame:
        """Size of the run: rows, cells, subsets, cell values, and cell values times rows."""
        if self.subsets is None:
            rows = (
                self.data.groupBy(self._key().alias("subset"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count("subset").alias("subsets"))
            )
        else:
            rows = self.data.agg(F.count(F.lit(1)).alias("rows")).withColumn(
                "subsets", F.lit(len(set(self.subsets))).cast("bigint")
            )
        return rows.select(
            "rows",
            F.lit(len(self.catalog)).cast("bigint").alias("cells"),
            "subsets",
            (F.lit(len(self.catalog)) * F.col("subsets")).alias("cell_values"),
            (F.lit(len(self.catalog)) * F.col("subsets") * F.col("rows")).alias("calculations"),
        )
