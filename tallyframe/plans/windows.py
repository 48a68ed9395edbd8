"""Reports of several windows and quarters from one scan, with the window as a grouping dimension."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions import ratio_status, safe_ratio
from tallyframe.operators.conditions import analyze
from tallyframe.operators.counts import lenient, quoted, wrapped
from tallyframe.operators.subsets import listed_subset
from tallyframe.plans.catalog import COUNT, RATIO, Catalog, bind_columns
from tallyframe.plans.containment import failing_conditions

WINDOW = ("quarter", "window")


def window_report(
    data: DataFrame,
    catalog: Catalog,
    bounds: DataFrame,
    cells: Iterable[str] | None = None,
    subsets: Sequence[str] | None = None,
    subset_column: str = layout.SUBSET_COLUMN,
    most_windows: int = 1000,
) -> DataFrame:
    """``quarter, window, cell, subset, value, numerator, denominator, status`` of counts and ratios for each row of ``bounds``.

    ``bounds`` is the table of ``window_table``: its columns take the place of a run's date literals. It is broadcast, after a check
    that it has at most ``most_windows`` rows. Conditions that don't mention a window are evaluated once a row, before the
    row meets the windows; one aggregation by window and subset counts all cells, and the nation is a second one over its result. Every window lists
    every subset that occurs. Medians and conditions that can't run beside others are ``FAILED``.
    """
    if bounds.limit(most_windows + 1).count() > most_windows:
        raise ValueError(f"more than {most_windows} windows")
    names = [c for c in bounds.columns if c not in WINDOW]
    run = catalog.select(cells)
    texts = {c.name: bind_columns(c.predicate, names) for c in run if c.kind == COUNT}
    both = data.crossJoin(F.broadcast(bounds))
    bad = failing_conditions(data.sparkSession, analyze(both, texts.values()))
    counted = {name: text for name, text in texts.items() if text not in bad}
    columns = {text: f"n{i}" for i, text in enumerate(dict.fromkeys(counted.values()))}
    # Windowless conditions are columns of the row already when it meets the windows.
    fixed = {text: f"held_{n}" for text, n in columns.items() if not any(b in text for b in names)}
    key = listed_subset(subset_column, subsets)
    with lenient(data.sparkSession):
        rows = data.select("*", key.alias("subset"), *[F.expr(f"{wrapped(text)} AS {held}") for text, held in fixed.items()])
        met = rows.crossJoin(F.broadcast(bounds))
        counters = [F.expr(f"count(CASE WHEN {fixed.get(text) or wrapped(text)} THEN 1 END) AS {n}") for text, n in columns.items()]
        grouped = met.groupBy(*WINDOW, "subset").agg(*counters)
    level = f"inline(array(struct(subset AS level), struct('{layout.NATIONAL}' AS level)))"
    listed = grouped.selectExpr(*WINDOW, *columns.values(), level).where("level IS NOT NULL")
    if subsets is not None:
        zero = bounds.select(*WINDOW, F.explode(F.lit([*subsets, layout.NATIONAL])).alias("level"))
        listed = listed.unionByName(zero, allowMissingColumns=True)
    wide = listed.groupBy(*WINDOW, F.col("level").alias("subset")).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in columns.values()])

    nothing = F.lit(None).cast("double")
    values, entries = {}, []
    for cell in run:
        first = second = nothing
        if cell.name in counted:
            first = values[cell.name] = F.col(columns[counted[cell.name]]).cast("double")
            status, value = F.lit(layout.OK), first
            first = nothing
        elif cell.kind == RATIO:
            first, second = values.get(cell.num, nothing), values.get(cell.den, nothing)
            status, value = ratio_status(first, second), safe_ratio(first, second)
            values[cell.name] = value
        else:
            status, value = F.lit(layout.MISSING if cell.kind == layout.MISSING else layout.FAILED), nothing
        whole = first.isNotNull() & second.isNotNull()
        entries.append(
            F.struct(F.lit(cell.name).alias("cell"), value.alias("value"), F.when(whole, first).alias("numerator"), F.when(whole, second).alias("denominator"), status.alias("status"))
        )
    return wide.select(*WINDOW, "subset", F.inline(F.array(*entries))).select(*WINDOW, "cell", "subset", "value", "numerator", "denominator", "status")
