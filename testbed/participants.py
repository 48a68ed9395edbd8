"""Derivation of raw participant records from lineitem, orders, customer and nation.

The column expressions are plain SQL shared by Spark and DuckDB; only the name of
the date formatting function differs (``{dt}``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.local import local_table
from tallyframe.operators.prepare import prepare_input

CODES = {
    "202": "l_partkey % 3",
    "301": "l_linenumber % 5",
    "401": "l_partkey % 8",
    "413": "l_suppkey % 4",
    "808": "l_linenumber",
    "904": "l_partkey % 6",
    "1602": "l_orderkey % 11",
    "1606": "l_orderkey % 13",
}

DATES = {
    "1000": "l_suppkey % 3",
    "1001": "l_partkey % 4",
    "1002": "l_suppkey % 2",
    "1007": "l_partkey % 3",
    "1100": "l_orderkey % 3",
    "1101": "l_orderkey % 4",
    "1102": "l_orderkey % 5",
    "1103": "l_partkey % 5",
    "1104": "l_partkey % 6",
    "1105": "l_partkey % 7",
    "1107": "l_suppkey % 5",
    "1112": "l_suppkey % 6",
    "1113": "l_suppkey % 7",
    "1201": "l_orderkey % 7",
}

OTHERS = {
    "900": "{dt(o_orderdate)}",
    "901": "case when l_linestatus = 'F' then {dt(l_shipdate)} end",
    "918": "case when l_returnflag = 'R' then '2' else '1' end",
    "923": "case when l_suppkey % 3 = 0 then '01' else '00' end",
    "1704": "case when l_partkey % 10 = 0 then '999999.99' when l_partkey % 11 = 0 then '' "
    "else cast(l_extendedprice as varchar(30)) end",
    "3000": "case when c_custkey % 53 = 0 then null "
    "when c_custkey % 59 = 0 then concat('N', cast(n_nationkey as varchar(2)), '_LONG') "
    "else concat('N', chr(cast(65 + n_nationkey as int))) end",
}


def _dated(text: str, dt: str) -> str:
    for column in ("o_orderdate", "l_shipdate"):
        text = text.replace("{dt(" + column + ")}", dt.format(column))
    return text


def column_sql(dt: str) -> dict[str, str]:
    """Raw column number -> SQL expression; ``dt`` formats a timestamp as ``yyyyMMdd``."""
    columns = {n: f"cast({e} as varchar(9))" for n, e in CODES.items()}
    columns |= {n: f"case when {e} = 0 then {dt.format('l_shipdate')} end" for n, e in DATES.items()}
    columns |= {n: _dated(e, dt) for n, e in OTHERS.items()}
    return dict(sorted(columns.items(), key=lambda kv: int(kv[0])))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def participants_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw participant records, all columns as strings."""
    items = read_table(spark, sf_dir, "lineitem")
    joined = (
        items.join(read_table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(read_table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(read_table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    exprs = column_sql("date_format({}, 'yyyyMMdd')")
    return joined.selectExpr(*[f"{e} AS PIRL{n}" for n, e in exprs.items()])


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared participant records."""
    return prepare_input(participants_raw(spark, sf_dir))


MEASURES = [
    (1, "Number Served (Reportable Individual)", 1),
    (2, "Employment Rate Second Quarter After Exit", 1),
    (3, "Employment Rate Fourth Quarter After Exit", 1),
    (4, "Other", 2),
]

# measure, active, months from the start of a quarter to the first day and past the last day
COHORT_SPANS = [(1, 1, -9, 3), (2, 1, -21, -9), (3, 1, -27, -15), (4, 1, -15, -3), (1, 0, -120, -117)]

# quarter 13 is the second quarter of 2001
QUARTER_NUMBER = "year(o_orderdate) * 4 + quarter(o_orderdate) - 7993"


def measures(spark: SparkSession) -> DataFrame:
    return local_table(spark, MEASURES, "MeasureID int, Measure string, ReportTypeID int")


def cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per span and every quarter in which something was ordered."""
    quarters = (
        read_table(spark, sf_dir, "orders")
        .groupBy(F.expr(QUARTER_NUMBER).alias("QuarterID"))
        .agg(F.to_date(F.date_trunc("quarter", F.min("o_orderdate"))).alias("first"))
    )
    spans = F.expr(
        "explode(array("
        + ", ".join(f"struct({m} AS m, {a} AS a, {b} AS b, {e} AS e)" for m, a, b, e in COHORT_SPANS)
        + "))"
    )
    return quarters.select("QuarterID", "first", spans.alias("s")).selectExpr(
        "s.m AS MeasureID",
        "QuarterID",
        "s.a AS IsActive",
        "concat(add_months(first, s.b), ' 00:00:00') AS CoveredDataStartDate",
        "concat(date_sub(add_months(first, s.e), 1), ' 00:00:00') AS CoveredDataEndDate",
    )
