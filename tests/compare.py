"""Run a catalogue query on both engines and compare columns and values."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, float):
        return f"{value:.6f}"
    return f"{type(value).__name__}:{value}"


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else what differs first."""
    got_cols, got = _table(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = _table([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        extra = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
        return f"rows {len(got)} != {len(want)}; {extra}"
    bad = [(a, b) for a, b in zip(got, want) if a != b][:2]
    return f"values {bad}" if bad else None
