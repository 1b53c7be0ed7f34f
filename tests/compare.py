"""Row comparison of a Spark frame with DuckDB SQL over the same tables."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def _plain(value):
    if isinstance(value, Decimal):
        return value.normalize() if value else Decimal(0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def as_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duck_rows(sql, folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    cursor = con.execute(sql)
    return as_rows([column[0] for column in cursor.description], cursor.fetchall())


def spark_rows(df):
    return as_rows(df.columns, [tuple(row) for row in df.collect()])
