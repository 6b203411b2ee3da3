"""Spark-vs-DuckDB comparison used by the tests and ``scripts/check_oracle.py``:
row count, column names and an order-insensitive hash of normalised values."""

from __future__ import annotations

import datetime as dt
import decimal
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
        return int(v)
    if isinstance(v, (decimal.Decimal, float)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return round(f, 6)
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return len(rows), sorted(columns), h


def compare(spark, fn, sql: str | None, sf_dir: str, con=None) -> dict:
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, s_rows)
    out = {"rows": s[0], "columns": s[1]}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    d = digest(cols, d_rows)
    out["oracle_rows"] = d[0]
    out["columns_match"] = s[1] == d[1]
    out["rows_match"] = s[0] == d[0]
    out["hash_match"] = s[2] == d[2]
    out["status"] = "ok" if (s[1] == d[1] and s[0] == d[0] and s[2] == d[2]) else "MISMATCH"
    if out["status"] != "ok":
        out["oracle_columns"] = d[1]
        ss = set(repr(tuple(_norm(r[i]) for i in sorted(range(len(df.columns)),
                                                          key=lambda i: df.columns[i])))
                 for r in s_rows)
        dd = set(repr(tuple(_norm(r[i]) for i in sorted(range(len(cols)), key=lambda i: cols[i])))
                 for r in d_rows)
        out["only_spark"] = sorted(ss - dd)[:3]
        out["only_oracle"] = sorted(dd - ss)[:3]
    return out
