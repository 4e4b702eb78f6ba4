"""Spark result vs DuckDB oracle: row count, column names and order-insensitive values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(data_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(records, columns):
    return sorted((tuple(_norm(r[c]) for c in columns) for r in records), key=repr)


def compare(spark_df, con, sql):
    """Returns (ok, message)."""
    s_cols = spark_df.columns
    o = con.sql(sql)
    o_cols = o.columns
    if sorted(s_cols) != sorted(o_cols):
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    cols = sorted(s_cols)
    s_rows = rows_of([r.asDict() for r in spark_df.collect()], cols)
    o_rows = rows_of([dict(zip(o_cols, r)) for r in o.fetchall()], cols)
    if len(s_rows) != len(o_rows):
        return False, f"row count differs: spark={len(s_rows)} oracle={len(o_rows)}"
    if s_rows != o_rows:
        diff = [(a, b) for a, b in zip(s_rows, o_rows) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(s_rows)} rows"
