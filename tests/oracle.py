"""Comparison of registered queries with their SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def plain(value):
    if value is None or isinstance(value, (str, bool, bytes)):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, int):
        return value
    return float(value) if type(value).__name__ == "Decimal" else str(value)


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(db, sql: str) -> tuple[list[str], list[tuple]]:
    found = db.execute(sql)
    columns = [c[0] for c in found.description]
    return rows_of(columns, found.fetchall())
