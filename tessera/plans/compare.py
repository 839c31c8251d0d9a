"""Compare a Spark result with an oracle SQL result (row count, columns, values).

Used by the tests and ``scripts/check_oracle.py``.  Values are normalised
strictly (decimal scale counts), rows compared as multisets with columns
sorted by name.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

BASE_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
               "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=False))
    return v


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
        out["values_match"] = False
        return out
    s_idx = [s_cols.index(c) for c in sorted(s_cols)]
    d_idx = [d_cols.index(c) for c in sorted(d_cols)]
    s_bag = Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_bag = Counter(tuple(_norm(r[i]) for i in d_idx) for r in d_rows)
    out["values_match"] = s_bag == d_bag
    if not out["values_match"]:
        out["only_spark"] = [r for r in (s_bag - d_bag)][:3]
        out["only_oracle"] = [r for r in (d_bag - s_bag)][:3]
    return out
