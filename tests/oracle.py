"""Compare a Spark result with its DuckDB statement."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return f"{type(v).__name__} {v}"


def _table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    cur = con.execute(sql)
    names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    want = _table(names, want)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{sorted(names)}: {g} != {w}"
    return None
