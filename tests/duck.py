"""Runs a query's SQL in DuckDB over the same tables, and compares rows."""

from __future__ import annotations

import os

import duckdb


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        path = f"{sf_dir}/{f}" + "/*.parquet" * os.path.isdir(f"{sf_dir}/{f}")
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(x):
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return str(bool(x))
    if isinstance(x, float) or type(x).__name__.startswith("float"):
        return "null" if x != x else repr(round(float(x), 6))
    return "null" if x is None else str(x)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(r[i]) for i in order) for r in data)


def compare(spark, sf_dir: str, run, sql: str) -> None:
    df = run(spark, sf_dir)
    cursor = views(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, cursor.fetchall())
