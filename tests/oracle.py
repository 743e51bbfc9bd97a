"""Holds a query's rows against its SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str):
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], list]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def sql_rows(con, sql: str) -> tuple[list[str], list]:
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)


def assert_same(df: DataFrame, con, sql: str) -> int:
    (a, x), (b, y) = spark_rows(df), sql_rows(con, sql)
    assert a == b, (a, b)
    assert len(x) == len(y), (len(x), len(y))
    wrong = [(p, q) for p, q in zip(x, y, strict=True) if p != q]
    assert not wrong, wrong[:3]
    return len(x)
