"""Compare a Spark query with its SQL equivalent, ignoring row and column order."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, datetime):
        return v.isoformat()
    return repr(v)


def _canonical(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_value(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return _canonical(df.columns, df.collect())


def sql_rows(con, sql: str):
    result = con.execute(sql)
    return _canonical([d[0] for d in result.description], result.fetchall())
