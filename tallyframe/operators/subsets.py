"""Subset codes: which groups a report lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe import layout

#: For the standard column; other columns have no bound unless one is given.
CODE_LENGTH = 2
STANDARD = -1


def code_length(column: str, max_length: int | None = STANDARD) -> int | None:
    """The longest code that counts as one: the standard column's bound, none for any other column, or as given."""
    if max_length == STANDARD:
        return CODE_LENGTH if column == layout.SUBSET_COLUMN else None
    return max_length


def is_listed(
    column: str = layout.SUBSET_COLUMN, codes: Sequence[str] | None = None, max_length: int | None = STANDARD
) -> Column:
    """Whether the row's code is listed, as a filter the scan can use.

    Listed are the given codes or, without them, every code of at most ``max_length`` characters, see ``code_length``.
    """
    if codes is None:
        longest = code_length(column, max_length)
        code = F.col(column)
        return code.isNotNull() if longest is None else F.length(code) <= longest
    return F.col(column).cast("string").isin(list(codes))


def listed_subset(
    column: str = layout.SUBSET_COLUMN, codes: Sequence[str] | None = None, max_length: int | None = STANDARD
) -> Column:
    """The subset code where it is listed, else NULL.

    Unlisted codes all fall into one NULL group, so that dirty codes cannot widen an
    aggregation: it has at most one group per listed code and one more.
    """
    return F.when(is_listed(column, codes, max_length), F.col(column).cast("string"))


def subset_list(data: DataFrame, column: str = layout.SUBSET_COLUMN, max_length: int | None = STANDARD) -> DataFrame:
    """Distinct listed codes found in the data."""
    return data.where(is_listed(column, max_length=max_length)).select(F.col(column).cast("string").alias("subset")).distinct()
