"""Column helpers built only from native Spark functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyframe import layout


def compact_date(text: Column) -> Column:
    """Date of a ``yyyyMMdd`` string; NULL for anything malformed."""
    return F.try_to_date(text, "yyyyMMdd")


def is_numeric(text: Column) -> Column:
    """True when the text reads as a number."""
    return text.try_cast("double").isNotNull()


def numeric_or_empty(text: Column) -> Column:
    return F.when(is_numeric(text), text).otherwise(F.lit(""))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double, NULL for a zero denominator or a missing operand."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_status(numerator: Column, denominator: Column) -> Column:
    """``OK``, ``a/0`` for a zero denominator, ``FAILED`` for a missing operand."""
    return (
        F.when(numerator.isNull() | denominator.isNull(), layout.FAILED)
        .when(denominator == 0, layout.ZERO_DENOMINATOR)
        .otherwise(layout.OK)
    )


def report_key(cell: Column, subset: Column) -> Column:
    """``cell`` for the nation, ``cell-subset`` for a subset."""
    return F.when(subset == layout.NATIONAL, cell).otherwise(F.concat_ws("-", cell, subset))


def split_report_key(key: Column) -> tuple[Column, Column]:
    """Cell and subset of a ``cell-subset`` key; a key without subset is national.

    The first hyphen separates them, so a subset code may contain hyphens itself.
    """
    pieces = F.split(key, "-", 2)
    subset = F.when(F.size(pieces) == 2, F.get(pieces, F.lit(1))).otherwise(layout.NATIONAL)
    return pieces[0], subset


def date_part(text: Column) -> Column:
    """Date before the first blank of a date-time string."""
    return F.split(text, " ")[0].try_cast("date")


def window_start(window: str, start: Column, end: Column) -> Column:
    """First day of a report window that ends on ``end``.

    ``cq`` is the quarter ending there, ``ptd`` runs from the program start, and
    every other name keeps the stored four-quarter start.
    """
    if window == "cq":
        return F.add_months(F.date_add(end, 1), -3)
    if window == "ptd":
        return F.lit(layout.PROGRAM_START).cast("date")
    return start
