"""Compare a Spark result with the same query in DuckDB, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def canonical(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (int(value) if value.is_integer() else value)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, int):
        return float(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(canonical(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=repr)


def difference(df, connection, sql: str) -> str | None:
    """None when both agree, else the first difference."""
    result = connection.sql(sql)
    want_columns, want = table(result.columns, result.fetchall())
    have_columns, have = table(df.columns, [tuple(r) for r in df.collect()])
    if want_columns != have_columns:
        return f"columns {have_columns} instead of {want_columns}"
    if len(want) != len(have):
        return f"{len(have)} rows instead of {len(want)}"
    wrong = [(h, w) for h, w in zip(have, want) if repr(h) != repr(w)]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
