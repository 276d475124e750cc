"""Runs a query in Spark and its oracle in DuckDB and compares rows as multisets."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    for kind in (int, float, decimal.Decimal, str, datetime.datetime, datetime.date):
        if isinstance(value, kind):
            return kind.__name__
    return type(value).__name__


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return sorted(names), rows


def kinds(rows: Counter) -> list[set[str]]:
    columns = zip(*rows) if rows else []
    return [{_kind(v) for v in column if v is not None} for column in columns]


def assert_same(df, con, sql: str) -> int:
    s_names, s_rows = spark_rows(df)
    d_names, d_rows = duck_rows(con, sql)
    assert s_names == d_names
    assert kinds(s_rows) == kinds(d_rows), (s_names, kinds(s_rows), kinds(d_rows))
    only_spark, only_duck = s_rows - d_rows, d_rows - s_rows
    assert not only_spark and not only_duck, (
        s_names,
        len(only_spark),
        len(only_duck),
        list(only_spark)[:3],
        list(only_duck)[:3],
    )
    return sum(s_rows.values())
