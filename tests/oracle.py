"""Compare a Spark query with its SQL twin in DuckDB, value by value."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return [cell(x) for x in v]
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted([str([cell(r[i]) for i in order]) for r in data])


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())


def differences(df, con, sql) -> list[str]:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    out = []
    if sc != dc:
        out.append(f"columns {sc} != {dc}")
    if len(sr) != len(dr):
        out.append(f"rows {len(sr)} != {len(dr)}")
    if sr != dr and not out:
        extra = [a for a, b in zip(sr, dr, strict=False) if a != b][:3]
        missing = [b for a, b in zip(sr, dr, strict=False) if a != b][:3]
        out.append(f"spark {extra} sql {missing}")
    elif sr != dr:
        out.append(f"spark only {sorted(set(sr) - set(dr))[:3]} sql only {sorted(set(dr) - set(sr))[:3]}")
    return out
