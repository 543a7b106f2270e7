"""Compare a query with its SQL text, run by DuckDB on the same Parquet files."""

from __future__ import annotations

from decimal import Decimal

import duckdb

from millrace.sources.tables import TABLE_NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return ("exact", value.normalize().to_eng_string())
    if isinstance(value, float):
        return ("float", repr(value))
    return (type(value).__name__, str(value))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql) -> tuple[int, str | None]:
    """Number of rows, and what differs if something does."""
    found = df.collect()
    answer = connection.execute(sql)
    names = [column[0] for column in answer.description]
    expected = answer.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(found), f"columns {sorted(df.columns)} against {sorted(names)}"
    left, right = _rows(df.columns, found), _rows(names, expected)
    if len(left) != len(right):
        return len(found), f"{len(left)} rows against {len(right)}"
    for one, other in zip(left, right):
        if one != other:
            return len(found), f"{one} against {other}"
    return len(found), None
