"""Preparation of raw participant records: prune, rename, type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions import compact_date


def prepared_name(raw: str) -> str:
    return raw.replace(layout.RAW_PREFIX, layout.PREPARED_PREFIX)


def prepare_input(
    raw: DataFrame,
    kept: Sequence[str] = tuple(layout.KEPT_COLUMNS),
    dates: Sequence[str] = tuple(layout.DATE_COLUMNS),
    codes: Sequence[str] = tuple(layout.CODE_COLUMNS),
    wage: str = layout.WAGE_COLUMN,
    partitions: int | None = None,
) -> DataFrame:
    """Typed input of a report, as one projection over the raw records.

    A kept column that is absent is an error; a date, code or wage column that is not
    kept is skipped. Values that do not parse become NULL, so no row can fail a run.
    ``partitions`` deals the rows out anew; without it the scan's own partitioning is
    kept and adaptive execution sizes what follows.
    """
    typed = []
    for name in kept:
        target, column = prepared_name(name), F.col(name)
        kind = raw.schema[name].dataType.typeName() if name in raw.columns else "string"
        if target in dates:
            dated = kind in ("date", "timestamp", "timestamp_ntz")
            column = column.cast("date") if dated else compact_date(column.cast("string"))
        elif target in codes:
            # codes written as decimals are cut to whole numbers
            column = F.coalesce(column.try_cast("int"), column.try_cast("decimal(38,10)").try_cast("int"))
        elif target == wage:
            column = column.try_cast("float")
        typed.append(column.alias(target))
    prepared = raw.select(*typed)
    return prepared if partitions is None else prepared.repartition(partitions)


def publish_input(prepared: DataFrame, view: str = "input", persist: bool = False) -> DataFrame:
    """Register the prepared records for SQL use; ``persist`` keeps them for repeated runs.

    Caching pays for interactive use on data that fits the cluster's storage. For large
    inputs write the prepared records once instead (``sources.write_prepared``), so
    that each run reads typed, pruned columns with filter pushdown.
    """
    if persist:
        prepared = prepared.persist()
    prepared.createOrReplaceTempView(view)
    return prepared
