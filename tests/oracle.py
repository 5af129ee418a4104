"""Side-by-side comparison of a Spark result and a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(part) for part in value)
    return value


def rows_of(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_plain(row[i]) for i in order)) for row in rows)


def differences(df, connection, sql: str, show: int = 3) -> list[str]:
    """Empty when both sides have the same columns, value types and rows."""
    result = connection.execute(sql)
    expected_columns = [column[0] for column in result.description]
    expected = rows_of(expected_columns, result.fetchall())
    actual = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(expected_columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(expected_columns)}"]
    if actual == expected:
        return []
    missing = sorted(set(expected) - set(actual))[:show]
    surplus = sorted(set(actual) - set(expected))[:show]
    counts = f"{len(actual)} rows instead of {len(expected)}"
    return [counts, *[f"missing {row}" for row in missing], *[f"surplus {row}" for row in surplus]]
