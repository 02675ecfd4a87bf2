"""Compares a registered query with its SQL in DuckDB, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else (f"{v:.9f}" if isinstance(v, float) else str(v))) for v in row)


def _equal(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=0, abs_tol=1e-12)
    return a == b


def differences(df, con, sql: str, limit: int = 3) -> list:
    """Empty when columns and rows are the same, whatever the order; otherwise what differs."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(names) != sorted(df.columns):
        return [("columns", sorted(df.columns), sorted(names))]
    order = sorted(names)
    expected = sorted(([row[names.index(c)] for c in order] for row in want.fetchall()), key=_key)
    actual = sorted(([row[c] for c in order] for row in df.collect()), key=_key)
    out = [] if len(expected) == len(actual) else [("rows", len(actual), len(expected))]
    for a, b in zip(actual, expected):
        if not all(_equal(x, y) for x, y in zip(a, b)):
            out.append((order, a, b))
            if len(out) >= limit:
                break
    return out
