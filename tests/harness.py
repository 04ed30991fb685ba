"""Runs a registered query and its SQL on the same tables and compares all values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.6g}"
    if isinstance(value, int):
        return f"{float(value):.6g}" if abs(value) < 100000 else str(value)
    return str(value)


def normal_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description of the first difference."""
    got_columns = spark_df.columns
    got = normal_rows(got_columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = normal_rows(want_columns, result.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns differ: {sorted(got_columns)} / {sorted(want_columns)}"
    if len(got) != len(want):
        return f"row counts differ: {len(got)} / {len(want)}"
    wrong = [(a, b) for a, b in zip(got, want) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first: {str(wrong[0][0])[:600]} / {str(wrong[0][1])[:600]}"
    return None
