"""Ad-hoc SQL over the published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def adhoc_sql(spark: SparkSession, text: str, max_rows: int = 10) -> DataFrame:
    """First rows of a query over ``input``, ``cohorts``, ``measures`` and ``periods``."""
    return spark.sql(text).limit(max_rows)
