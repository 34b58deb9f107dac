"""Helpers to compare a Spark query with its DuckDB oracle."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(data_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in records]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return [columns[i] for i in order], rows


def compare(spark_df, con, sql: str) -> dict:
    """Row count, column names and sorted values of both sides."""
    s_cols = spark_df.columns
    s_recs = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_recs = res.fetchall()
    sc, sr = rows_of(s_cols, s_recs)
    dc, dr = rows_of(d_cols, d_recs)
    out = {
        "spark_rows": len(sr),
        "oracle_rows": len(dr),
        "columns_match": sc == dc,
        "values_match": sr == dr,
    }
    if not out["values_match"]:
        ss, ds = set(sr), set(dr)
        out["only_spark"] = list(ss - ds)[:3]
        out["only_oracle"] = list(ds - ss)[:3]
    return out
