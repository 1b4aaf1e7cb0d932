"""Side-by-side check of a Spark query and its DuckDB oracle, the way the
driver does it: row count, column names, order-insensitive values."""

from __future__ import annotations

import datetime as dt
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
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = _rows(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = _rows(d_cols, res.fetchall())
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} oracle={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} oracle={len(d_rows)}")
    if not problems and s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems, len(s_rows)
