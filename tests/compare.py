"""Compare query results with their SQL counterparts (column names, types aside, and values)."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def normal(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return float(f"{v:.12g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=key)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())
