"""Side-by-side check of a Spark query against its DuckDB oracle:
row count, column names and an order-insensitive multiset of rows."""

from __future__ import annotations

import datetime as _dt
from collections import Counter
from decimal import Decimal

from starloom.sources.tables import DRIVER_TABLES, table_path


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, Decimal):
        return str(v)
    if isinstance(v, _dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def duckdb_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, query, sql: str, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = df.collect()
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(o_rows),
           "columns_match": sorted(s_cols) == sorted(o_cols)}
    if out["columns_match"]:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        oi = [o_cols.index(c) for c in order]
        a = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
        b = Counter(tuple(_norm(r[i]) for i in oi) for r in o_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).items())[:3]
            out["only_oracle"] = list((b - a).items())[:3]
    else:
        out["spark_cols"], out["oracle_cols"] = s_cols, o_cols
        out["values_match"] = False
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
