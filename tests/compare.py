"""Rows of a query against the rows of its DuckDB statement."""

import os

import duckdb


def shown(v) -> str:
    if isinstance(v, float):
        return f"{v:.9g}"
    return "null" if v is None else str(v)


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def assert_same(df, sql: str, sf_dir: str) -> None:
    want = duck(sf_dir).sql(sql)
    names = sorted(df.columns)
    assert names == sorted(want.columns)
    got = sorted(tuple(shown(r[n]) for n in names) for r in df.collect())
    at = [want.columns.index(n) for n in names]
    assert got == sorted(tuple(shown(r[i]) for i in at) for r in want.fetchall())
