"""Row-for-row comparison of catalog queries with their reference SQL."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb


def canonical(value):
    if value is None or value != value:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, (datetime.datetime, bytes, bytearray)):
        return str(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(
        (tuple(canonical(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r))
    )


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(sf_dir, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return rows_of(columns, result.fetchall())
