"""Compare a query with its SQL: same columns, same rows in any order."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value if value is None or isinstance(value, (int, str, bool)) else repr(value)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in records), key=repr)


def compare(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    have_columns, have = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = rows_of([c[0] for c in result.description], result.fetchall())
    if have_columns != want_columns:
        return f"columns {have_columns} != {want_columns}"
    if len(have) != len(want):
        return f"{len(have)} rows, expected {len(want)}; first {have[:2]} / {want[:2]}"
    for h, w in zip(have, want):
        if h != w:
            return f"columns {have_columns}\n  {h}\n  expected\n  {w}"
    return None
