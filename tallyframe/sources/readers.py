"""Readers for participant records, reference tables and report configuration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe import layout
from tallyframe.functions import split_report_key

COHORTS_SCHEMA = (
    "MeasureID int, QuarterID int, IsActive int, "
    "CoveredDataStartDate string, CoveredDataEndDate string"
)
MEASURES_SCHEMA = "MeasureID int, Measure string, ReportTypeID int"


def read_participants(spark: SparkSession, path: str) -> DataFrame:
    """Raw participant records from Parquet."""
    return spark.read.parquet(path)


def typed_value(column: Column, kind: str) -> Column:
    """The value as the declared type, NULL where it can't be read; whole numbers may be written as decimals."""
    if kind == "int":
        return F.coalesce(column.try_cast("int"), column.try_cast("decimal(38,10)").try_cast("int"))
    return column.try_cast(kind)


def schema_fields(schema: str) -> list[tuple[str, str]]:
    """Names and types of a schema such as ``a int, b string``."""
    return [(name, kind) for name, kind in (f.strip().split(" ") for f in schema.split(","))]


def typed_reference(table: DataFrame, schema: str) -> DataFrame:
    """The named columns cast to the declared types: whole numbers may be written as decimals, unreadable values are NULL."""
    return table.select(*[typed_value(F.col(name), kind).alias(name) for name, kind in schema_fields(schema)])


def read_reference_csv(
    spark: SparkSession, cohorts: str, measures: str
) -> tuple[DataFrame, DataFrame]:
    """Cohorts and measures from CSV files with a header; columns are found by name."""

    def read(path: str, schema: str) -> DataFrame:
        return typed_reference(spark.read.option("header", True).csv(path), schema)

    return read(cohorts, COHORTS_SCHEMA), read(measures, MEASURES_SCHEMA)


def read_reference_jdbc(
    spark: SparkSession, url: str, properties: Mapping[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Cohorts and measures from the database tables of those names."""

    def read(table: str, schema: str) -> DataFrame:
        return typed_reference(
            spark.read.jdbc(url=url, table=table, properties=dict(properties or {})), schema
        )

    return read(layout.COHORTS_TABLE, COHORTS_SCHEMA), read(layout.MEASURES_TABLE, MEASURES_SCHEMA)


def publish_reference(
    cohorts: DataFrame, measures: DataFrame, periods: DataFrame | None = None, persist: bool = True
) -> None:
    """Register the reference tables for SQL use, cached by default as they are small."""
    for name, table in (("cohorts", cohorts), ("measures", measures), ("periods", periods)):
        if table is not None:
            (table.persist() if persist else table).createOrReplaceTempView(name)


# --- configuration texts --------------------------------------------------------


def content_lines(lines: DataFrame) -> DataFrame:
    """Trimmed lines of a ``value`` column without blank and ``//`` comment lines."""
    trimmed = lines.withColumn("value", F.trim("value"))
    return trimmed.where("value <> '' AND NOT startswith(value, '//')")


def parse_expected(lines: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """Expected values ``(cell, subset, expected)`` from ``cell-subset = value`` lines.

    A line that does not split into exactly two pieces has an empty expected value, and
    a key without subset is national. One row per key: with ``order`` its last line counts,
    without it the largest text.
    """
    pieces = F.split("value", " = ")
    cell, subset = split_report_key(pieces[0])
    parsed = content_lines(lines).select(
        cell.alias("cell"),
        subset.alias("subset"),
        F.when(F.size(pieces) == 2, F.get(pieces, F.lit(1))).otherwise("").alias("expected"),
        *[c.alias(f"_order{i}") for i, c in enumerate(order)],
    )
    if not order:
        return parsed.groupBy("cell", "subset").agg(F.max("expected").alias("expected"))
    rank = F.struct(*[f"_order{i}" for i in range(len(order))])
    return parsed.groupBy("cell", "subset").agg(F.max_by("expected", rank).alias("expected"))


def read_expected(spark: SparkSession, path: str) -> DataFrame:
    """Expected values from a text file, the last line of a key counting."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return parse_expected(lines, [F.col("file"), F.col("block"), F.col("line")])


def read_names(spark: SparkSession, path: str) -> list[str]:
    """A configured list of names, e.g. columns to keep: one per line, comments skipped."""
    return [r["value"] for r in content_lines(spark.read.text(path)).collect()]


def read_abbreviations(spark: SparkSession, path: str) -> dict[str, str]:
    """Abbreviations ``key = value`` of a cell definition file."""
    pieces = F.split("value", " = ")
    rows = content_lines(spark.read.text(path)).select(pieces[0].alias("k"), F.get(pieces, F.lit(1)).alias("v"))
    return {r["k"]: r["v"] or "" for r in rows.collect()}


def subset_codes(lines: DataFrame) -> DataFrame:
    """Subset codes from the first line of a text, comma separated."""
    first = lines.limit(1)
    return first.select(F.explode(F.split("value", ",")).alias("subset")).select(
        F.trim("subset").alias("subset")
    )


def read_subset_codes(spark: SparkSession, path: str) -> list[str]:
    """Static subset list: the first line of the file, comma separated, in sorted order."""
    return sorted(r["subset"] for r in subset_codes(spark.read.text(path)).collect())
