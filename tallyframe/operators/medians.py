"""Exact medians of many filtered groups, without holding a group in one task.

Values are first reduced to one row per subset and distinct value. A monotone bucket
of the value then narrows each group to the bucket or two that hold its middle ranks:
bucket totals give the rank before a bucket, and only the values of those buckets are
ranked. A bucket spans 1/1024 of a power of two and therefore at most about 8,200
distinct single-precision values, and there are at most about 550,000 buckets, so the
work per group is bounded whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.operators.counts import LEVEL, count_where, lenient, spread_levels, wrapped

BUCKETS_PER_OCTAVE = 1024
MAX_BROADCAST_PICKS = 100_000
GROUP = ("cell", *LEVEL)
_LOWEST_OCTAVE = 150  # below the smallest single-precision exponent
_HIGHEST_OCTAVE = 200.0  # above the largest, stands in for infinity
_NAN_BUCKET = 1 << 40


def value_bucket(value: Column) -> Column:
    """Bucket number that never decreases as the value grows; NaN is last."""
    octave = F.least(F.log2(F.abs(value)), F.lit(_HIGHEST_OCTAVE)) + _LOWEST_OCTAVE
    size = F.floor(octave * BUCKETS_PER_OCTAVE)
    bucket = (
        F.when(F.isnan(value), F.lit(_NAN_BUCKET).cast("bigint"))
        .when(value > 0, size)
        .when(value < 0, -size)
    )
    return F.coalesce(bucket, F.lit(0).cast("bigint"))


def value_counts(
    data: DataFrame, conditions: Mapping[str, str], value: str, subset: Column
) -> DataFrame:
    """One row per subset and distinct value with a counter per condition.

    Rows that meet no condition are dropped before the shuffle, and the disjunction
    lets Catalyst push what the conditions have in common into the scan.
    """
    flags = {name: F.expr(wrapped(text)) for name, text in conditions.items()}
    x = F.col(value).try_cast("float")
    wanted = None
    for flag in flags.values():
        wanted = flag if wanted is None else wanted | flag
    with lenient(data.sparkSession):
        kept = data.where(wanted & F.col(value).isNotNull() & x.isNotNull())
        return kept.groupBy(
            F.coalesce(subset, F.lit("")).alias("code"), subset.isNotNull().alias("listed"), x.alias("x")
        ).agg(*[count_where(flag).alias(name) for name, flag in flags.items()])


def exact_medians(
    data: DataFrame,
    conditions: Mapping[str, str],
    value: str,
    subset: Column,
    national: bool = True,
    by_subset: bool = True,
    max_subsets: int | None = None,
) -> DataFrame:
    """Rows ``(cell, national, subset, median)`` for every non-empty group.

    The median is the middle value, or for an even count the mean of the two middle
    ones, in single precision. The nation takes in all rows, listed or not.

    ``max_subsets`` is the number of codes that ``subset`` can take, where that is known.
    A group picks at most two buckets, so it bounds the picked side of the join, which is
    then broadcast instead of shuffling every distinct value to it. Without the bound, or
    beyond ``MAX_BROADCAST_PICKS``, both sides are shuffled by bucket.
    """
    if not national:
        data = data.where(subset.isNotNull())
    if not by_subset:
        subset = F.lit(None).cast("string")
    per_value = value_counts(data, conditions, value, subset)
    rows = (
        per_value.unpivot(["code", "listed", "x"], list(conditions), "cell", "n")
        .where("n > 0")
        .select("cell", F.when(F.col("listed"), F.col("code")).alias("subset"), "x", "n")
    )
    rows = median_levels(rows, national, by_subset).withColumn("bucket", value_bucket(F.col("x")))
    picked = middle_buckets(rows)
    known = max_subsets if by_subset else 0
    if known is not None and 2 * len(conditions) * (known + 1) <= MAX_BROADCAST_PICKS:
        picked = F.broadcast(picked)
    return middle_values(rows, picked)


def median_levels(rows: DataFrame, national: bool, by_subset: bool) -> DataFrame:
    """Rows ``cell, subset, n`` and more as contributions to the levels asked for; a NULL subset counts for the nation only."""
    others = [c for c in rows.columns if c != "subset"]
    if national and by_subset:
        rows = spread_levels(rows)
    else:
        own = "subset" if by_subset else f"'{layout.NATIONAL}'"
        rows = rows.selectExpr(f"{national} AS national", f"{own} AS subset", *others)
    return rows.select("national", F.coalesce("subset", F.lit("")).alias("subset"), *others)


def middle_buckets(rows: DataFrame) -> DataFrame:
    """The one or two buckets of each cell and level that hold its middle ranks, and those ranks within them.

    ``rows``: ``cell, national, subset, bucket, n``, any number of rows a bucket.
    """
    totals = rows.groupBy(*GROUP, "bucket").agg(F.sum("n").alias("held"))
    whole = Window.partitionBy(*GROUP)
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        totals.withColumn("before", F.sum("held").over(upto) - F.col("held"))
        .withColumn("size", F.sum("held").over(whole))
        .select(
            *GROUP,
            "bucket",
            "held",
            (F.expr("(size + 1) div 2") - F.col("before")).alias("lower"),
            (F.expr("size div 2 + 1") - F.col("before")).alias("upper"),
        )
        .where("lower BETWEEN 1 AND held OR upper BETWEEN 1 AND held")
    )


def middle_values(rows: DataFrame, picked: DataFrame) -> DataFrame:
    """``cell, national, subset, median`` from rows ``cell, national, subset, bucket, x, n`` and their picked buckets."""
    ranked = Window.partitionBy(*GROUP, "bucket").orderBy("x")
    ranked = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = (
        rows.join(picked, [*GROUP, "bucket"])
        # the nation's rows come from every subset: one row a value, whatever the number of subsets
        .groupBy(*GROUP, "bucket", "x")
        .agg(F.sum("n").alias("n"), F.max("lower").alias("lower"), F.max("upper").alias("upper"))
        .withColumn("reached", F.sum("n").over(ranked))
        .groupBy(*GROUP)
        .agg(
            F.max(F.when(F.expr("lower BETWEEN reached - n + 1 AND reached"), F.col("x"))).alias("low"),
            F.max(F.when(F.expr("upper BETWEEN reached - n + 1 AND reached"), F.col("x"))).alias("high"),
        )
    )
    mean = (F.col("low").cast("double") + F.col("high").cast("double")) / 2
    return middle.select(*GROUP, mean.cast("float").alias("median"))
