"""Comparison of a Spark result with the DuckDB result of the same name."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: Path):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(
        tuple(_plain(row[i]) for i in order) for row in rows
    )


def differences(df, connection, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = _rows(names, cursor.fetchall())
    columns, found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if found != expected:
        missing, extra = expected - found, found - expected
        return (
            f"rows {sum(found.values())} vs {sum(expected.values())}; "
            f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
        )
    return None
