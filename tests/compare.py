"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    if isinstance(value, dt.datetime):
        return value.date().isoformat() if value.time() == dt.time() else value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return "" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_frame, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(spark_frame.columns):
        return f"columns {sorted(spark_frame.columns)} instead of {sorted(columns)}"
    got = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} instead of {b}"
    return None
