"""Differential check: a registered Spark query vs its DuckDB oracle SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from lunchbox.sources.testdata import TABLES


def duck_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, f"{round(v, 6):.6f}")
    if isinstance(v, decimal.Decimal):
        return (1, f"{round(float(v), 6):.6f}")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, int):
        return (1, f"{float(v):.6f}")
    if isinstance(v, (dt.datetime, dt.date)):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, str(v))


def compare(spark, name: str, sf_dir: str, query_fn, sql: str | None, con=None):
    """Return (ok, message)."""
    sdf = query_fn(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = sdf.collect()
    if sql is None:
        return True, f"{name}: {len(s_rows)} rows (no oracle)"
    con = con or duck_connection(sf_dir)
    rel = con.sql(sql)
    d_cols = sorted(rel.columns)
    d_rows = rel.fetchall()
    if s_cols != d_cols:
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows differ spark={len(s_rows)} duck={len(d_rows)}"
    s_idx = [sdf.columns.index(c) for c in s_cols]
    d_idx = [rel.columns.index(c) for c in d_cols]
    s_set = sorted(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_set = sorted(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    if s_set != d_set:
        diff = [(a, b) for a, b in zip(s_set, d_set) if a != b][:3]
        return False, f"{name}: values differ, first: {diff}"
    return True, f"{name}: {len(s_rows)} rows match"
