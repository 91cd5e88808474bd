"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9) + 0.0
    return value


def rows_of_spark(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(normal(r[c]) for c in columns) for r in df.collect()), key=repr)


def rows_of_duckdb(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    return columns, sorted((tuple(normal(r[i]) for i in order) for r in result.fetchall()), key=repr)


def kinds(rows):
    """Python type per column, from the first non-null values."""
    return [
        next((type(r[i]).__name__ for r in rows if r[i] is not None), None) for i in range(len(rows[0]) if rows else 0)
    ]
