"""Runs a registered Spark query and its DuckDB oracle on the same parquet
tables and compares row count, column names and an order-free value hash
(floats rounded to 6 digits), like the driver's correctness gate."""

from __future__ import annotations

import hashlib
import math

import duckdb

from ferret.sources.tables import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    return str(v)


def digest(cols, rows) -> tuple[int, list[str], str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha1("\n".join(lines).encode()).hexdigest()
    return len(rows), [cols[i] for i in order], h


def compare(spark, fn, sql: str, sf_dir: str, con=None):
    df = fn(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, srows)
    con = con or duck(sf_dir)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    d = digest(dcols, drows)
    return s, d, srows, drows, df.columns, dcols
