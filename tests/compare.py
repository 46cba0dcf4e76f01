"""Compare a Spark DataFrame with a DuckDB SQL result (order-insensitive).

Mirrors the driver's correctness gate: same row count, same column names,
same multiset of rows. Doubles must be bit-identical unless ``tol`` is set.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from hirebook.sources.testdata import TABLES


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tol):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2**53:
            return int(v)
        if tol:
            return round(v / tol) * tol
        return v + 0.0
    if hasattr(v, "item"):
        return _norm(v.item(), tol)
    if isinstance(v, pd.Timestamp):
        return v.date()
    return v


def rows_of(df: pd.DataFrame, tol=None):
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, tol) for v in rec))
    return cols, sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df, con, sql: str, tol=None) -> dict:
    s = spark_df.toPandas()
    d = con.execute(sql).df()
    res = {"spark_rows": len(s), "oracle_rows": len(d)}
    sc, sr = rows_of(s, tol)
    dc, dr = rows_of(d, tol)
    res["columns_match"] = sc == dc
    if sc != dc:
        res["spark_cols"], res["oracle_cols"] = sc, dc
    res["values_match"] = sc == dc and sr == dr
    if res["columns_match"] and not res["values_match"]:
        a, b = set(sr), set(dr)
        res["only_spark"] = sorted(a - b, key=str)[:3]
        res["only_oracle"] = sorted(b - a, key=str)[:3]
    res["ok"] = res["values_match"] and len(s) == len(d)
    return res
