"""Rows of a Spark query against rows of its SQL in an independent engine."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TESTDATA = Path("/root/testdata")


def oracle_rows(folder: Path, sql: str):
    with duckdb.connect() as connection:
        for file in sorted(folder.glob("*.parquet")):
            connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
        result = connection.execute(sql)
        names = [column[0] for column in result.description]
        types = {column[0]: str(column[1]) for column in result.description}
        return names, types, result.fetchall()


def bag(names, rows):
    """Rows as a multiset, columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (Decimal, int, str, type(None))):
        return (type(value).__name__, value)
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def assert_same(df, folder: Path, sql: str) -> int:
    names, _, expected = oracle_rows(folder, sql)
    actual = [tuple(row) for row in df.collect()]
    assert sorted(df.columns) == sorted(names)
    left, right = bag(df.columns, actual), bag(names, expected)
    assert left == right, (
        f"{sum((left - right).values())} rows only in Spark, e.g. {list((left - right))[:2]}; "
        f"{sum((right - left).values())} only in the oracle, e.g. {list((right - left))[:2]}"
    )
    return len(actual)
