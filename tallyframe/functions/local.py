"""Small driver-side configuration as tables whose size the optimizer knows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows as a local relation, so that joins with it are planned from its true size."""
    struct = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [[] for _ in struct]
    arrow = to_arrow_schema(struct)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema=struct)
