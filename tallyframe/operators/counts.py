"""Filtered counts of many conditions in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions.local import local_table

LEVEL = ("national", "subset")


def quoted(name: str) -> str:
    """The name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true. One conditional per row and counter."""
    return F.count(F.when(condition, 1))


def wrapped(text: str) -> str:
    """The condition as one operand: in parentheses that a comment at its end can't swallow."""
    return f"({text}\n)"


_one_at_a_time = RLock()


@contextmanager
def lenient(spark: SparkSession) -> Iterator[None]:
    """Frames made inside give NULL where a comparison's cast or a division fails, instead of an error.

    Spark fixes this per expression when a frame is made; the session's setting is as before afterwards. Threads that
    make reports wait for each other here, so none restores the other's setting.
    """
    name = "spark.sql.ansi.enabled"
    with _one_at_a_time:
        before = spark.conf.get(name)
        spark.conf.set(name, "false")
        try:
            yield
        finally:
            spark.conf.set(name, before)


def tune_session(spark: SparkSession, counters: int = 300) -> None:
    """Settings for sessions that run wide reports; nothing in the library calls it.

    By default whole-stage code generation stops at 100 fields, and a wider aggregate runs
    about 1.6 times slower. Methods beyond 8000 bytes of bytecode are never optimized by
    HotSpot, so stages that would generate one are left to the split, smaller projections.
    """
    fields, method = "spark.sql.codegen.maxFields", "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(fields)) < counters + 50:
        spark.conf.set(fields, str(counters + 50))
    if int(spark.conf.get(method)) > 8000:
        spark.conf.set(method, "8000")


def group_counts(
    data: DataFrame, conditions: Mapping[str, str], subset: Column | None = None
) -> DataFrame:
    """One row per subset (or a single row) with one counter column per condition.

    All conditions share one scan. Tasks send one row per subset to the shuffle, so a
    subset holding most of the rows is no heavier than any other.
    """
    counters = [
        F.expr(f"count(CASE WHEN {wrapped(text)} THEN 1 END) AS {quoted(name)}")
        for name, text in conditions.items()
    ]
    if not counters:
        return data.sparkSession.range(1).select() if subset is None else data.select(subset.alias("subset")).distinct()
    with lenient(data.sparkSession):
        return data.agg(*counters) if subset is None else data.groupBy(subset.alias("subset")).agg(*counters)


def spread_levels(grouped: DataFrame, total: str = "all") -> DataFrame:
    """Grouped rows as contributions to their own subset and to the national level.

    ``total`` says which rows make up the nation: ``all`` of them or only the
    ``listed`` subsets. Unlisted rows (NULL subset) get no row of their own.
    """
    if total == "listed":
        grouped = grouped.where("subset IS NOT NULL")
    levels = (
        "inline(array(struct(false AS national, subset AS subset), "
        f"struct(true AS national, '{layout.NATIONAL}' AS subset)))"
    )
    others = [quoted(c) for c in grouped.columns if c != "subset"]
    return grouped.selectExpr(levels, *others).where("national OR subset IS NOT NULL")


def zero_rows(
    spark: SparkSession, names: Sequence[str], subsets: Sequence[str] | None = None
) -> DataFrame:
    """Zero contributions for the nation and every subset that must appear."""
    rows = [(True, layout.NATIONAL)] + [(False, s) for s in subsets or ()]
    levels = local_table(spark, rows, "national boolean, subset string")
    return levels.selectExpr(*LEVEL, *[f"0L AS {quoted(n)}" for n in names])


def count_levels(
    data: DataFrame,
    conditions: Mapping[str, str],
    subset: Column,
    subsets: Sequence[str] | None = None,
    total: str = "all",
    grouped: Callable[[DataFrame, Mapping[str, str], Column], DataFrame] = group_counts,
) -> DataFrame:
    """Wide counts per listed subset and for the nation, absent subsets filled with 0.

    ``grouped`` counts by subset; it sees the input once.
    The input is aggregated once by subset. The national row and the zero filling are
    a second aggregation over that small result, not over the input.
    """
    names = list(conditions)
    parts = spread_levels(grouped(data, conditions, subset), total).unionByName(
        zero_rows(data.sparkSession, names, subsets)
    )
    return parts.groupBy(*LEVEL).agg(*[F.expr(f"sum({quoted(n)}) AS {quoted(n)}") for n in names])


def long_counts(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Wide counts as rows ``(cell, national, subset, n)``."""
    return wide.unpivot(list(LEVEL), [quoted(n) for n in names], "cell", "n")
