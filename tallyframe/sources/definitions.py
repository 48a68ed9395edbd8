"""Import of cell definitions given as a JSON array of ``{id, type, query}`` objects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.plans.catalog import COUNT, MEDIAN, RATIO, REFINE, Catalog, Cell

# --- fixed values: names used in definition files --------------------------------

KIND_NAMES = {
    "count": COUNT,
    "median": MEDIAN,
    "formula-concatenator": REFINE,
    "formula-division": RATIO,
}

WINDOW_NAMES = {
    "_begAbc_": ":abc_start",
    "_endAbc_": ":abc_end",
    "_begExit2q_": ":exit2q_start",
    "_endExit2q_": ":exit2q_end",
    "_begExit4q_": ":exit4q_start",
    "_endExit4q_": ":exit4q_end",
}

STANDARD_ABBREVIATIONS = {
    "_scfIw_": "SELECT count( * ) AS count FROM input WHERE",
    "_swfIw_": "SELECT p1704 AS values FROM input WHERE",
    "_inn_": "IS NOT NULL",
    "_in_": "IS NULL",
}

_DEFINITION = "id string, type string, query string"


def parse_definitions(
    definitions: DataFrame, abbreviations: Mapping[str, str] | None = None
) -> DataFrame:
    """Definitions as catalog columns: ``cell, kind, parent, joiner, predicate, value, num, den``.

    ``kind`` is NULL for an unknown type, ``pieces`` counts the parts of a refinement.
    Further columns of the input are kept.
    """
    names = STANDARD_ABBREVIATIONS if abbreviations is None else abbreviations
    query = F.trim("query")
    for name, text in (*names.items(), *WINDOW_NAMES.items()):
        query = F.replace(query, F.lit(name), F.lit(text))
    kinds = F.create_map(*[F.lit(x) for pair in KIND_NAMES.items() for x in pair])
    kept = [c for c in definitions.columns if c not in ("id", "type", "query")]

    parsed = definitions.select(
        *kept,
        F.col("id").alias("cell"),
        F.try_element_at(kinds, "type").alias("kind"),
        query.alias("text"),
    )
    is_refine, is_ratio = F.col("kind") == REFINE, F.col("kind") == RATIO
    base = F.col("kind").isin(COUNT, MEDIAN)
    parts, sides = F.split("text", " :: "), F.split("text", "/")
    extra = F.trim(F.get(parts, F.lit(1)))
    return parsed.select(
        *kept,
        "cell",
        "kind",
        F.when(is_refine, F.trim(parts[0])).alias("parent"),
        F.when(is_refine, F.upper(F.regexp_extract(extra, r"(?i)^(AND|OR)\b", 1))).alias("joiner"),
        F.when(base, F.regexp_extract("text", r"(?is)\bFROM\s+input\s+WHERE\s+(.*)$", 1))
        .when(is_refine, F.regexp_extract(extra, r"(?is)^(?:AND|OR)\s+(.*)$", 1))
        .alias("predicate"),
        F.when(F.col("kind") == MEDIAN, F.regexp_extract("text", r"(?i)^SELECT\s+(\w+)\s+AS\b", 1)).alias("value"),
        F.when(is_ratio, F.trim(sides[0])).alias("num"),
        F.when(is_ratio, F.trim(F.get(sides, F.lit(1)))).alias("den"),
        F.when(is_refine, F.size(parts)).alias("pieces"),
    )


def catalog_from(parsed: DataFrame, wrap: bool = False) -> Catalog:
    """Catalog of parsed definitions in their order. Collects the definitions only."""
    cells = []
    for row in parsed.collect():
        if row["kind"] is None:
            raise ValueError(f"cell {row['cell']}: unknown type")
        if row["kind"] in (COUNT, MEDIAN, REFINE) and not row["predicate"]:
            raise ValueError(f"cell {row['cell']}: no condition found in its definition")
        if row["kind"] == REFINE and row["pieces"] != 2:
            raise ValueError(f"cell {row['cell']}: a refinement has exactly one ' :: '")
        cells.append(
            Cell(
                row["cell"],
                row["kind"],
                predicate=row["predicate"],
                parent=row["parent"],
                num=row["num"],
                den=row["den"],
                joiner=row["joiner"] or "AND",
                **({"value": row["value"]} if row["value"] else {}),
            )
        )
    return Catalog(cells, wrap=wrap)


def read_catalog(
    spark: SparkSession,
    path: str,
    abbreviations: Mapping[str, str] | None = None,
    wrap: bool = False,
) -> Catalog:
    """Catalog from a JSON definition file, in file order."""
    raw = spark.read.schema(_DEFINITION).option("multiLine", True).json(path)
    return catalog_from(parse_definitions(raw, abbreviations), wrap=wrap)
