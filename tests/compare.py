"""Comparing a Spark result with DuckDB's answer to the SQL text."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows, names):
    """Rows as a sorted list, columns in name order, values in comparable form."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if v is None:
            return "~"
        if isinstance(v, datetime.datetime):
            return v.replace(tzinfo=None).isoformat(timespec="microseconds")
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.12g}"
        return str(v)

    return sorted(tuple(value(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return canonical([tuple(r) for r in df.collect()], df.columns)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return canonical(result.fetchall(), names), sorted(names)
