"""Run a registered query in Spark and its oracle SQL in DuckDB, compare.

Mirrors the driver's check: same column names, same row count, and the
same multiset of rows once columns are sorted by name. Doubles are compared
after rounding to 9 significant decimals.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, con, name: str, builder, sql: str, data_dir: str) -> dict:
    sdf = builder(spark, data_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows)}
    if sorted(s_cols) != sorted(d_cols):
        out["error"] = f"columns differ: {sorted(s_cols)} vs {sorted(d_cols)}"
        return out
    s_idx = [s_cols.index(c) for c in sorted(s_cols)]
    d_idx = [d_cols.index(c) for c in sorted(d_cols)]
    s_norm = sorted((tuple(_norm(r[i]) for i in s_idx) for r in s_rows), key=_key)
    d_norm = sorted((tuple(_norm(r[i]) for i in d_idx) for r in d_rows), key=_key)
    if len(s_norm) != len(d_norm):
        out["error"] = "row counts differ"
    elif s_norm != d_norm:
        diff = [(a, b) for a, b in zip(s_norm, d_norm) if a != b][:3]
        out["error"] = f"values differ, e.g. {diff}"
    else:
        types = []
        for c, a, b in zip(sorted(s_cols), s_norm[0] if s_norm else (), d_norm[0] if d_norm else ()):
            if a is not None and b is not None and type(a) is not type(b):
                types.append((c, type(a).__name__, type(b).__name__))
        if types:
            out["error"] = f"value types differ: {types}"
    out["ok"] = "error" not in out
    return out
