"""Run a query in Spark and its SQL in DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, Decimal):
        return f"decimal {v}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return v


def spark_rows(df):
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, sorted((repr([_plain(x) for x in r]) for r in rows))


def sql_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = cur.fetchall()
    return [cols[i] for i in order], sorted(repr([_plain(r[i]) for i in order]) for r in rows)


def sql_types(con, sql):
    return {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}


SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
}


def differences(df, con, sql):
    """A list of what differs; empty when the results agree."""
    out = []
    a_cols, a = spark_rows(df)
    b_cols, b = sql_rows(con, sql)
    if a_cols != b_cols:
        return [f"columns {a_cols} != {b_cols}"]
    types = sql_types(con, sql)
    for name, kind in df.dtypes:
        if SPARK_TO_SQL.get(kind, kind) != types[name]:
            out.append(f"type of {name}: {kind} != {types[name]}")
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a = sorted(set(a) - set(b))[:2]
        only_b = sorted(set(b) - set(a))[:2]
        out.append(f"values differ: spark {only_a} sql {only_b}")
    return out
