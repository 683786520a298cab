"""Comparing a query's rows with its SQL on DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[str], list[tuple]]:
    kinds = [t for _, t in sorted(df.dtypes)]
    return sorted(df.columns), kinds, sorted_rows(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    kinds = [str(t) for _, t in sorted((d[0], d[1]) for d in cursor.description)]
    return sorted(columns), kinds, sorted_rows(columns, cursor.fetchall())
