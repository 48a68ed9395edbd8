"""Lines of text sources that can't be used, beside those that can.

Each function splits lines into ``(rows, rejects)``. Every line is in exactly one of them, so their counts add up to the
lines read. ``rejects`` has ``source, line, reason``: the name given, the line as text, and what is wrong with it. Both are
lazy and derive from the same frame; nothing is gathered.

Defined results: blank values are NULL, not bad, unless required; a line with several faults names all of them in the
order of the columns; blank lines and comments of configuration texts are no lines; repeated lines are judged one by one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.functions import split_report_key
from tallyframe.operators.counts import quoted
from tallyframe.plans.catalog import COUNT, MEDIAN, REFINE
from tallyframe.sources.definitions import parse_definitions
from tallyframe.sources.readers import content_lines, schema_fields, typed_value

CORRUPT = "_corrupt_record"


def _split(judged: DataFrame, source: str, rows: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``judged`` has the line as ``line_`` and in ``reason_`` what is wrong with it, blank where nothing is."""
    bad = judged.where("reason_ <> ''").select(F.lit(source).alias("source"), F.col("line_").alias("line"), F.col("reason_").alias("reason"))
    return judged.where("reason_ = ''").select(*rows), bad


def _reasons(faults: Mapping[str, Column]) -> Column:
    """The names of the faults that hold, in order."""
    return F.array_join(F.array_compact(F.array(*[F.when(fault, F.lit(name)) for name, fault in faults.items()])), "; ")


def reference_rows(table: DataFrame, schema: str, source: str, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of a text table in the declared types; rejected are those with a value that can't be read or a blank in a ``required`` column.

    A ``_corrupt_record`` column, as Spark's readers fill it, rejects its line as a whole.
    """
    fields = schema_fields(schema)
    text = {name: F.col(quoted(name)).cast("string") for name, _ in fields}
    typed = {name: typed_value(F.trim(text[name]) if kind != "string" else text[name], kind) for name, kind in fields}
    blank = {name: F.coalesce(F.trim(text[name]), F.lit("")) == "" for name, _ in fields}
    faults: dict[str, Column] = {}
    for name, kind in fields:
        if name in required:
            faults[f"{name}: nothing given"] = blank[name]
        faults[f"{name}: no {kind}"] = ~blank[name] & typed[name].isNull()
    line, reason = F.concat_ws(",", *[F.coalesce(t, F.lit("")) for t in text.values()]), _reasons(faults)
    if CORRUPT in table.columns:
        broken = F.col(CORRUPT)
        line, reason = F.coalesce(broken, line), F.when(broken.isNotNull(), "number of fields").otherwise(reason)
    judged = table.select(line.alias("line_"), reason.alias("reason_"), *[typed[name].alias(name) for name, _ in fields])
    return _split(judged, source, [F.col(quoted(name)) for name, _ in fields])


def read_reference_checked(spark: SparkSession, path: str, schema: str, source: str, required: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``reference_rows`` of CSV files with a header, whose columns are those of ``schema`` in that order."""
    names = ", ".join(f"{quoted(name)} string" for name, _ in schema_fields(schema))
    read = spark.read.option("header", True).option("enforceSchema", True).option("columnNameOfCorruptRecord", CORRUPT)
    return reference_rows(read.schema(f"{names}, {CORRUPT} string").csv(path), schema, source, required)


def expected_rows(lines: DataFrame, source: str, order: Sequence[Column] = ()) -> tuple[DataFrame, DataFrame]:
    """Lines of expected values that count, as ``cell, subset, expected``, and those that say nothing or are overruled by another line of their key.

    The line that counts is the one ``parse_expected`` takes: the last by ``order``, else the one with the largest text.
    A line without exactly one value is rejected here; where it is its key's only line, ``parse_expected`` reads it as empty.
    """
    pieces = F.split("value", " = ")
    cell, subset = split_report_key(pieces[0])
    single = F.size(pieces) == 2
    held = content_lines(lines).select(
        F.col("value").alias("line_"), cell.alias("cell"), subset.alias("subset"), F.when(single, F.get(pieces, F.lit(1))).otherwise("").alias("expected"),
        single.alias("single_"), *[c.alias(f"order{i}_") for i, c in enumerate(order)],
    )
    rank = [F.desc(f"order{i}_") for i in range(len(order))] or [F.desc("expected")]
    place = F.row_number().over(Window.partitionBy("cell", "subset").orderBy(*rank))
    faults = {"no single value": ~F.col("single_"), "overruled by another line": F.col("place_") > 1}
    judged = held.withColumn("place_", place).withColumn("reason_", _reasons(faults))
    return _split(judged, source, [F.col(c) for c in ("cell", "subset", "expected")])


def definition_rows(definitions: DataFrame, source: str, abbreviations: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Cell definitions as ``parse_definitions`` gives them, and those that make no cell: the faults for which ``catalog_from`` raises."""
    columns = ["id", "type", "query"]
    shown = F.to_json(F.struct(*columns))
    parsed = parse_definitions(definitions.select(*columns, shown.alias("line_")), abbreviations)
    kind = F.col("kind")
    faults = {
        "no name": F.coalesce(F.trim("cell"), F.lit("")) == "",
        "unknown type": kind.isNull(),
        "no condition": kind.isin(COUNT, MEDIAN, REFINE) & (F.coalesce("predicate", F.lit("")) == ""),
        "not one ' :: '": (kind == REFINE) & (F.coalesce("pieces", F.lit(0)) != 2),
    }
    judged = parsed.withColumn("reason_", _reasons(faults))
    return _split(judged, source, [F.col(c) for c in parsed.columns if c != "line_"])
