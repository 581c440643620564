"""Compares a query's result with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def oracle_connection(directory: str = DATA) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return connection


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> str | None:
    """None when both results hold the same rows, else what differs."""
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    expected = bag(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(columns)}"
    actual = bag(df.columns, [tuple(row) for row in df.collect()])
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"rows {sum(actual.values())} expected {sum(expected.values())}; "
        f"missing {list(missing)[:3]}; extra {list(extra)[:3]}"
    )


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value
