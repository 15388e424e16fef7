"""Run a registered query in Spark and its oracle SQL in DuckDB, and compare."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(x)) for x in row)


def compare(spark_df, con, sql: str):
    """Return (ok, message). Columns compared by name, rows order-insensitive."""
    rel = con.sql(sql)
    o_cols = list(rel.columns)
    o_rows = rel.fetchall()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    order = [o_cols.index(c) for c in s_cols]
    o_rows = [tuple(r[i] for i in order) for r in o_rows]
    if len(s_rows) != len(o_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(o_rows)}"
    s_norm = sorted((tuple(_norm(x) for x in r) for r in s_rows), key=_key)
    o_norm = sorted((tuple(_norm(x) for x in r) for r in o_rows), key=_key)
    for a, b in zip(s_norm, o_norm):
        if a != b:
            return False, f"first differing row: spark={a} oracle={b}"
    return True, f"{len(s_rows)} rows"
