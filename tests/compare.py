"""Local stand-in for the driver's correctness gate: run a registered query on
Spark and its SQL on DuckDB over the same parquet files, then compare row
count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math
from datetime import date, datetime
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9) + 0.0)
    if isinstance(v, Decimal):
        return repr(round(float(v), 9) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(v, date):
        return v.isoformat()
    return str(v)


def digest(columns, rows) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("\x1f".join(str(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], len(lines), h


def spark_rows(df):
    cols = df.columns
    return cols, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    return cols, rel.fetchall()


def compare(spark, con, name, fn, sql, sf_dir):
    sc, sr = spark_rows(fn(spark, sf_dir))
    dc, dr = duck_rows(con, sql)
    a, b = digest(sc, sr), digest(dc, dr)
    return {
        "name": name,
        "rows": (a[1], b[1]),
        "columns_match": a[0] == b[0],
        "hash_match": a[2] == b[2],
        "spark_cols": a[0],
        "duck_cols": b[0],
        "spark_rows": sr,
        "duck_rows": dr,
    }
