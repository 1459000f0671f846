"""Compare a Spark DataFrame with a DuckDB query, order-insensitively.

Columns are compared by name (sorted), values normalised so that the two
engines' Python types agree (Decimal vs float, NaN, timestamps).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        return ("num", round(float(v), 6))
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("num", round(v, 6))
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("num", round(float(v), 6))
    if isinstance(v, _dt.datetime):
        if v.tzinfo is not None:
            v = v.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return ("ts", v.isoformat())
    if isinstance(v, _dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return ("str", str(v))


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    data = rel.fetchall()
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def compare(df, con, sql) -> tuple[bool, str]:
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row counts differ: spark={len(sr)} duck={len(dr)}"
    key = lambda r: repr(r)
    a, b = sorted(sr, key=key), sorted(dr, key=key)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first differing row: spark={x} duck={y}"
    return True, f"{len(sr)} rows"
