"""Helpers shared by the operators for training data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
#: Sorts behind every id; stands for a null id where ids are compared.
LAST_ID = (1 << 63) - 1


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local one only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="tallyframe-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = work_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """All columns of ``docs`` as the struct ``row_`` beside the ``keys``, so that no name of theirs can clash with others; ``row_.*`` gives them back."""
    return docs.select(F.struct(F.col("*")).alias("row_"), *[c.alias(n) for n, c in keys.items()])


def words(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def parts(rows: int, each: int, least: int = 1) -> int:
    """Number of partitions for so many rows."""
    return max(least, -(-rows // each))
