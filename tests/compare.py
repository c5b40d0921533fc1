"""Runs a query in Spark and its SQL in DuckDB and compares the rows without regard to order."""

from __future__ import annotations

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if hasattr(value, "asDict"):
        return tuple(sorted((k, plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return value


def rows_of_spark(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
