"""Spark-vs-DuckDB comparison in the driver's manner: columns sorted by
name, row count, schema names, order-insensitive value hash."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 1e15:
            return float(int(v))
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def frame_digest(cols: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return names, len(rows), h


def spark_digest(df):
    rows = [tuple(r) for r in df.collect()]
    return frame_digest(df.columns, rows)


def duck_digest(con, sql: str):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    rows = rel.fetchall()
    return frame_digest(cols, rows)


def first_diff(df, con, sql: str, n: int = 5):
    """A few rows present on one side only (for debugging)."""
    s_cols = df.columns
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    srows = {repr(tuple(_norm(r[i]) for i in order)) for r in df.collect()}
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    dorder = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    drows = {repr(tuple(_norm(r[i]) for i in dorder)) for r in rel.fetchall()}
    return sorted(srows - drows)[:n], sorted(drows - srows)[:n]
