"""Compare a Spark query with its DuckDB oracle: rows, columns, values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return v.isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if v is None:
        return "NULL"
    return str(v)


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in spark_df.dtypes}
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["types_match"] = s_types == d_types
    if not out["types_match"]:
        out["type_diff"] = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(s_cols), sorted(d_cols)
        return out
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    out["values_match"] = sc == dc
    if not out["values_match"]:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        out["cols"] = order
        out["only_spark"] = only_s
        out["only_oracle"] = only_d
    return out
