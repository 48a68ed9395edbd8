"""Writers for reports and prepared records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# raw text shrinks to about a fifth of it as Parquet, so that a part becomes a file of some 200 MB
PART_BYTES = 1 << 30


def write_report(report: DataFrame, path: str, single_file: bool = True) -> None:
    """The report as quoted CSV with a header.

    A report has one row per cell and listed subset, so it fits one file; pass
    ``single_file=False`` to keep the partitioning. Sorted rows stay sorted.
    """
    out = report.coalesce(1) if single_file else report
    out.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path. Their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def parts_of(size: int, part_bytes: int = PART_BYTES) -> int:
    return max(1, -(-size // part_bytes))


def clustered(rows: DataFrame, by: Sequence[str], parts: int | None = None, tie: Column | None = None) -> DataFrame:
    """Rows dealt by ranges of ``by`` and sorted by it in each part, so that file and row group footers hold narrow ranges.

    Without a number of parts they are the session's shuffle partitions, which adaptive execution joins where they are small.

    A key that many rows share (a hot subset, no exit date) is cut by ``tie``, by default a hash of the row. Give
    something that differs between equal rows where whole records may repeat that often; it has to give a row the same
    value when a lost task runs again.
    """
    spread = F.xxhash64(*[F.struct(c) for c in rows.columns]) if tie is None else tie
    keyed, keys = rows.withColumn("tie_", spread), (*by, "tie_")
    dealt = keyed.repartitionByRange(*keys) if parts is None else keyed.repartitionByRange(parts, *keys)
    return dealt.drop("tie_").sortWithinPartitions(*by)


def write_prepared(
    prepared: DataFrame, path: str, partitions: int | None = None, cluster_by: Sequence[str] = (), row_group_bytes: int | None = None
) -> None:
    """Prepared records as Parquet, to be read by any number of report runs.

    With ``cluster_by`` (subset and exit date, say) scans of one subset skip other files and row groups by their footers.
    ``row_group_bytes`` sets the writer's row group size.
    """
    out = prepared
    if cluster_by:
        out = clustered(prepared, cluster_by, partitions)
    elif partitions is not None:
        out = prepared.repartition(partitions)
    writer = out.write if row_group_bytes is None else out.write.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    partitions: int | None = None,
    header: bool = False,
    cluster_by: Sequence[str] = (),
    part_bytes: int = PART_BYTES,
) -> None:
    """Bulk conversion of CSV records to Parquet, all columns as text.

    Without a number of partitions it follows from the bytes stored at ``source``. ``cluster_by`` names columns whose
    ranges the files are cut by; the place of a record in its file tells equal records apart, so no key and no group of
    copies lands in one file. Ranges cost a second pass over the source (Spark samples their bounds).
    """
    rows = spark.read.option("header", header).csv(source)
    parts = parts_of(stored_bytes(spark, source), part_bytes) if partitions is None else partitions
    if cluster_by:
        out = clustered(rows, cluster_by, parts, F.monotonically_increasing_id())
    else:
        out = rows.repartition(parts)
    out.write.parquet(target)
