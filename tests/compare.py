"""Spark result against DuckDB on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return f"b:{v}"
    if isinstance(v, float):
        return f"f:{v:.9g}"
    return f"{type(v).__name__[0]}:{v}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str):
    """(number of rows, message); the message is empty on a match."""
    got_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_rows = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return len(got_rows), f"columns {sorted(df.columns)} != {sorted(names)}"
    got, want = rows_of(df.columns, got_rows), rows_of(names, want_rows)
    if got == want:
        return len(got), ""
    g, w = set(got), set(want)
    return len(got), (
        f"rows {len(got)} vs {len(want)}; only spark {sorted(g - w)[:3]}; only duckdb {sorted(w - g)[:3]}"
    )
