"""Comparing a query's rows with those of its SQL counterpart in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, _ordered([tuple(row[n] for n in names) for row in df.select(*[f"`{n}`" for n in names]).collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    found = [d[0] for d in cursor.description]
    places = sorted(range(len(found)), key=lambda i: found[i])
    rows = cursor.fetchall()
    return [found[i] for i in places], _ordered([tuple(row[i] for i in places) for row in rows])


def _ordered(rows: list[tuple]) -> list[tuple]:
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def _plain(value):
    if isinstance(value, float):
        return value + 0.0 if math.isfinite(value) else repr(value)
    return value
