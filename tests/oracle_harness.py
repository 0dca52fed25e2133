"""Run a registered Spark query and its DuckDB oracle; compare the results.

Compares row count, column names (sorted) and the multiset of rows with
columns in name order, as the driver's correctness gate does.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, name: str, query, sql: str | None, con=None) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = df.collect()
    out = {"name": name, "spark_rows": len(s_rows), "columns": sorted(s_cols)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out["duck_rows"] = len(d_rows)
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_rows = ok_cols and _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    out["status"] = "match" if (ok_cols and ok_rows and len(s_rows) == len(d_rows)) else "MISMATCH"
    if not ok_cols:
        out["duck_columns"] = sorted(d_cols)
    elif not ok_rows:
        a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_duck"] = list((b - a).elements())[:3]
    return out
