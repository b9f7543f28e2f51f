"""Compare a Spark query with its DuckDB oracle: row count, column names and
an order-insensitive hash of values (floats rounded to 9 significant
digits, timestamps normalised)."""

from __future__ import annotations

import datetime as dt
import hashlib
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v:.9g}"
    if hasattr(v, "is_integer") and not isinstance(v, int):  # Decimal
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, con, fn, sql: str, sf_dir: str) -> dict:
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    res = {"rows_spark": len(s_rows), "rows_oracle": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    res["hash_match"] = res["cols_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not res["cols_match"]:
        res["cols"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
    return res
