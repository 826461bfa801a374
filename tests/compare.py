"""Run a registered query and its SQL counterpart and compare the rows."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value if value is None else f"{type(value).__name__} {value}"


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted([tuple(cell(r[n]) for n in names) for r in df.collect()], key=repr)


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(cell(r[i]) for i in places) for r in result.fetchall()]
    return [columns[i] for i in places], sorted(rows, key=repr)
