"""Runs a query on Spark and its oracle on DuckDB and compares columns, types and rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_large_string(t):
        return "string"
    return str(t)


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def _rows(table: pa.Table, names) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(tuple(_cell(v) for v in row) for row in zip(*columns))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise what differs first."""
    ours, theirs = df.toArrow(), con.sql(sql).to_arrow_table()
    names = sorted(ours.column_names)
    if names != sorted(theirs.column_names):
        return f"columns {names} / {sorted(theirs.column_names)}"
    kinds = {n: (_kind(ours.schema.field(n).type), _kind(theirs.schema.field(n).type)) for n in names}
    wrong = {n: k for n, k in kinds.items() if k[0] != k[1]}
    if wrong:
        return f"types {wrong}"
    a, b = _rows(ours, names), _rows(theirs, names)
    if len(a) != len(b):
        return f"row counts {len(a)} / {len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return f"rows {dict(zip(names, x))} / {dict(zip(names, y))}"
    return None
