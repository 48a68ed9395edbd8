"""Reporting periods and the report windows derived from them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions import date_part, window_start


def periods(
    measures: DataFrame, cohorts: DataFrame, quarter: int = layout.DEFAULT_QUARTER
) -> DataFrame:
    """Current and previous period of every reported measure, in sequence order.

    Only active cohorts count. Both quarters come from one join: a cohort row belongs to
    exactly one of them, so its label and sequence are an expression, not a second branch.
    """
    wanted = cohorts.where(F.col("QuarterID").isin(quarter, quarter - 1) & (F.col("IsActive") == 1))
    current = F.col("QuarterID") == quarter
    step = F.when(current, 0).otherwise(layout.PREVIOUS_SEQUENCE_STEP)
    return (
        measures.where(F.col("ReportTypeID") == layout.REPORT_TYPE)
        .join(wanted, "MeasureID")
        .select(
            F.when(current, "Current").otherwise("Previous").alias("period"),
            F.col("Measure").alias("measure"),
            date_part(F.col("CoveredDataStartDate")).alias("start"),
            date_part(F.col("CoveredDataEndDate")).alias("end"),
            (F.col("MeasureID").cast("int") + step).alias("sequence"),
        )
        .orderBy("sequence")
    )


def report_windows(period_table: DataFrame, window: str = "r4q") -> DataFrame:
    """The window of each measure a report filters on: ``(name, measure, start, end)``.

    ``window`` is ``r4q``, ``cq`` or ``ptd``. If a measure has several current periods the
    one first in sequence is taken.
    """
    names = F.create_map(*[F.lit(x) for n, m in layout.WINDOW_MEASURES.items() for x in (m, n)])
    first = (
        period_table.where("period = 'Current'")
        .where(F.col("measure").isin(list(layout.WINDOW_MEASURES.values())))
        .groupBy("measure")
        .agg(F.min_by(F.struct("start", "end"), "sequence").alias("stored"))
    )
    start, end = F.col("stored.start"), F.col("stored.end")
    return first.select(
        F.try_element_at(names, "measure").alias("name"),
        "measure",
        window_start(window, start, end).alias("start"),
        end.alias("end"),
    )


def window_table(
    measures: DataFrame, cohorts: DataFrame, windows: Sequence[str] = layout.WINDOWS, quarters: Sequence[int] | None = None
) -> DataFrame:
    """The bounds of every window of every quarter as a table: ``quarter, window`` and two dates per measure, e.g. ``abc_start``.

    Quarters without an active cohort for each measure have no row. One row per quarter and window.
    """
    named = F.create_map(*[F.lit(x) for n, m in layout.WINDOW_MEASURES.items() for x in (m, n)])
    wanted = cohorts.where(F.col("IsActive") == 1)
    if quarters is not None:
        wanted = wanted.where(F.col("QuarterID").isin(list(quarters)))
    reported = measures.where((F.col("ReportTypeID") == layout.REPORT_TYPE) & F.col("Measure").isin(list(layout.WINDOW_MEASURES.values())))
    stored = F.struct(date_part(F.col("CoveredDataStartDate")).alias("start"), date_part(F.col("CoveredDataEndDate")).alias("end"))
    first = (
        reported.join(wanted, "MeasureID")
        .groupBy(F.col("QuarterID").cast("int").alias("quarter"), F.try_element_at(named, "Measure").alias("name"))
        .agg(F.min_by(stored, F.col("MeasureID").cast("int")).alias("stored"))
    )
    start, end = F.col("stored.start"), F.col("stored.end")
    spans = F.array(*[F.struct(F.lit(w).alias("window"), window_start(w, start, end).alias("start"), end.alias("end")) for w in windows])
    each = first.select("quarter", "name", F.inline(spans))
    bounds = [f"{n}_{side}" for n in layout.WINDOW_MEASURES for side in ("start", "end")]
    of = lambda b: F.max(F.when(F.col("name") == b.rsplit("_", 1)[0], F.col(b.rsplit("_", 1)[1]))).alias(b)
    return each.groupBy("quarter", "window").agg(*[of(b) for b in bounds]).dropna(subset=bounds)


def window_bounds(windows: DataFrame) -> dict[str, dt.date]:
    """Window bounds by parameter name, e.g. ``abc_start``. Brings at most three rows."""
    rows = windows.collect()
    absent = set(layout.WINDOW_MEASURES) - {r["name"] for r in rows}
    if absent:
        measures = ", ".join(layout.WINDOW_MEASURES[n] for n in sorted(absent))
        raise ValueError(f"no current period for: {measures}")
    bounds = {}
    for row in rows:
        bounds[f"{row['name']}_start"] = row["start"]
        bounds[f"{row['name']}_end"] = row["end"]
    return bounds
