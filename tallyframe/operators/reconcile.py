"""Comparison of results with expected values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions import numeric_or_empty, report_key


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _same_number(want: Column, got: Column, kind: Column) -> Column:
    """Whether both read as the same number in the precision of the cell: whole, single or double."""
    same = lambda t: F.coalesce(want.try_cast(t) == got.try_cast(t), F.lit(False))
    return F.when(kind == "count", same("decimal(38,6)")).when(kind == "median", same("float")).otherwise(same("double"))


def compare_expected(results: DataFrame, expected: DataFrame, by_number: bool = False) -> DataFrame:
    """Results with the nine report columns and an ``outcome`` per row.

    ``results`` carries ``cell, subset, numerator, denominator, actual, query`` as text
    and ``expected`` one text per ``cell, subset``. Equal texts are a ``hit``, different
    ones a ``miss``; if either is absent or empty the row is ``missing``. Expected values
    without a result are not reported. With ``by_number`` texts that read as the same number in the precision of the result's
    ``kind`` are a hit too (``12`` and ``12.0``, ``1.5`` and ``1.50E0``); statuses stay texts.
    """
    joined = results.join(expected, ["cell", "subset"], "left")
    want, got = _text("expected"), _text("actual")
    outcome = (
        F.when((want == "") | (got == ""), "missing").when((want == got) | _same_number(want, got, F.col("kind")) if by_number else want == got, "hit").otherwise("miss")
    )
    shown = {
        "cell": F.col("cell"),
        "subset": F.col("subset"),
        "value": numeric_or_empty(got),
        "numerator": numeric_or_empty(_text("numerator")),
        "denominator": numeric_or_empty(_text("denominator")),
        "expected": F.when(want == "", layout.MISSING).otherwise(want),
        "actual": F.when(got == "", layout.MISSING).otherwise(got),
        "match": F.when(outcome == "hit", "true").otherwise("false"),
        "query": F.col("query"),
    }
    return joined.select(
        *[shown[name].alias(name) for name in layout.REPORT_COLUMNS], outcome.alias("outcome")
    )


def report_rows(compared: DataFrame) -> DataFrame:
    """The report: nine columns ordered by ``cell`` or ``cell-subset``."""
    return compared.orderBy(report_key(F.col("cell"), F.col("subset"))).select(
        *layout.REPORT_COLUMNS
    )


def accuracy_summary(compared: DataFrame) -> DataFrame:
    """Hits, misses, missing rows and the percentage of hits."""
    tally = compared.agg(
        *[
            F.count(F.when(F.col("outcome") == outcome, 1)).alias(name)
            for outcome, name in (("hit", "hits"), ("miss", "misses"), ("missing", "missing"))
        ]
    )
    share = F.try_divide(
        F.col("hits").cast("double"), (F.col("hits") + F.col("misses") + F.col("missing")).cast("double")
    )
    return tally.withColumn("accuracy", share * 100)
