"""Compare a Spark result with its DuckDB oracle: rows, columns, values."""

from __future__ import annotations

import math

import duckdb
import datetime as dt

import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    if isinstance(v, dt.datetime):
        return v
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _sorted_rows(cols, rows) -> list:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           for x in r))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
                 "boolean": "BOOLEAN"}


def type_problems(spark_df, con, sql: str) -> list:
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
          for f in spark_df.schema.fields}
    dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = {k: (st.get(k), dt.get(k)) for k in set(st) | set(dt) if st.get(k) != dt.get(k)}
    return [f"types differ: {bad}"] if bad else []


def compare(spark_df, con, sql: str):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    problems = type_problems(spark_df, con, sql)
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns differ: spark={sorted(s_cols)} oracle={sorted(o_cols)}")
        return problems
    if len(s_rows) != len(o_rows):
        problems.append(f"row count spark={len(s_rows)} oracle={len(o_rows)}")
    rs, ro = _sorted_rows(s_cols, s_rows), _sorted_rows(o_cols, o_rows)
    if rs != ro:
        diff = [(a, b) for a, b in zip(rs, ro) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}; cols={sorted(s_cols)}")
    return problems
