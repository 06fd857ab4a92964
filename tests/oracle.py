"""Compares a query with its SQL: columns and types by name, rows as a bag, values exactly."""

from __future__ import annotations

import glob
import os

import duckdb


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    given = {f.name: f.dataType.simpleString() for f in df.schema}
    types = {c[0]: TYPES[str(c[1])] for c in cursor.description}
    if given != types:
        return f"types {sorted(given.items() ^ types.items())}"
    order = sorted(names)
    expected = sorted(repr([dict(zip(names, row))[c] for c in order]) for row in cursor.fetchall())
    actual = sorted(repr([row[c] for c in order]) for row in df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows, expected {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first: {str(wrong[0])[:600]}" if wrong else None
