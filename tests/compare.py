"""Compare Spark results with DuckDB's on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    database = duckdb.connect()
    database.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        database.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return database


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(result, database, statement: str) -> list[str]:
    """Human-readable differences in columns, types or rows; empty when equal."""
    expected = database.sql(statement)
    found = []
    if sorted(result.columns) != sorted(expected.columns):
        return [f"columns {sorted(result.columns)} != {sorted(expected.columns)}"]
    types = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    ours = {name: types.get(kind, kind) for name, kind in result.dtypes}
    theirs = {name: str(kind) for name, kind in zip(expected.columns, expected.types)}
    for name, kind in ours.items():
        if theirs[name] != kind:
            found.append(f"type of {name}: {kind} != {theirs[name]}")
    left = sorted_rows(result.columns, map(tuple, result.collect()))
    right = sorted_rows(expected.columns, expected.fetchall())
    if len(left) != len(right):
        found.append(f"row count {len(left)} != {len(right)}")
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first: {unequal[0][0]} != {unequal[0][1]}")
    return found
