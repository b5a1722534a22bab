"""Compare a Spark result with a DuckDB result: row count, column names and
an order-insensitive hash of the values (doubles compared at 9 significant
digits, so last-bit float noise does not count as a difference)."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import hashlib
import math
import os

import duckdb


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        t = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def digest(columns: list[str], rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    hashes = sorted(
        hashlib.sha1(repr(tuple(_norm(r[i]) for i in order)).encode()).hexdigest() for r in rows
    )
    return len(hashes), hashlib.sha1("".join(hashes).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = list(spark_df.columns)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    s_n, s_h = digest(s_cols, s_rows)
    d_n, d_h = digest(d_cols, d_rows)
    return {
        "rows_spark": s_n,
        "rows_oracle": d_n,
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "values_match": s_h == d_h,
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
        "ok": s_n == d_n and sorted(s_cols) == sorted(d_cols) and s_h == d_h,
    }


def first_difference(spark_df, con, sql: str, limit: int = 5):
    """A few rows present on one side only (for debugging)."""
    s_cols = list(spark_df.columns)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    cols = sorted(s_cols)
    si = [s_cols.index(c) for c in cols]
    di = [d_cols.index(c) for c in cols] if sorted(d_cols) == cols else None
    s_set = {tuple(_norm(r[i]) for i in si) for r in spark_df.collect()}
    if di is None:
        return {"columns": (s_cols, d_cols)}
    d_set = {tuple(_norm(r[i]) for i in di) for r in res.fetchall()}
    return {
        "columns": cols,
        "spark_only": sorted(s_set - d_set, key=repr)[:limit],
        "oracle_only": sorted(d_set - s_set, key=repr)[:limit],
    }
