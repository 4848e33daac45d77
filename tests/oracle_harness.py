"""Run a registered Spark query and its DuckDB oracle on the same parquet tables and compare.

Comparison: column names, logical types, row count and the exact multiset of
row values (decimals compared numerically, doubles bit for bit).
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                  "date": "DATE", "boolean": "BOOLEAN"}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, decimal.Decimal):
        return "D" + format(v.normalize(), "f") if v != 0 else "D0"
    if isinstance(v, float):
        return "F" + repr(v)
    if isinstance(v, int):
        return "I" + str(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return "S" + str(v)


def spark_type(dt_) -> str:
    s = dt_.simpleString()
    if s.startswith("decimal"):
        return s.upper().replace(" ", "")
    return _SPARK_TO_DUCK.get(s, s.upper())


def compare(spark, con, query_fn, sql: str, sf_dir: str) -> dict:
    sdf = query_fn(spark, sf_dir)
    s_cols = [(f.name, spark_type(f.dataType)) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [(d[0], str(d[1]).upper().replace(" ", "")) for d in cur.description]
    d_rows = cur.fetchall()
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows)}
    res["names_match"] = sorted(c for c, _ in s_cols) == sorted(c for c, _ in d_cols)
    s_types, d_types = dict(s_cols), dict(d_cols)
    res["type_diffs"] = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
    if res["names_match"]:
        order = [c for c, _ in s_cols]
        d_idx = [[c for c, _ in d_cols].index(c) for c in order]
        sc = Counter(tuple(_canon(v) for v in r) for r in s_rows)
        dc = Counter(tuple(_canon(r[i]) for i in d_idx) for r in d_rows)
        res["values_match"] = sc == dc
        if sc != dc:
            res["only_spark"] = list((sc - dc).elements())[:3]
            res["only_oracle"] = list((dc - sc).elements())[:3]
            res["columns"] = order
    else:
        res["values_match"] = False
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
    res["ok"] = res["names_match"] and res["values_match"] and not res["type_diffs"] \
        and res["spark_rows"] == res["oracle_rows"]
    return res
