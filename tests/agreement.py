"""Comparing a query with its SQL on the same tables."""

from __future__ import annotations

import decimal
import math
from pathlib import Path

import duckdb


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    return value


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def assert_agrees(df, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    found = con.sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(found.columns, found.fetchall())
