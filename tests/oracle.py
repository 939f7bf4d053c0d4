"""Compares a Spark result with a DuckDB query over the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 4)
    if isinstance(value, list):
        return tuple(map(_plain, value))
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def assert_same(df, sql: str, sf: str = SF) -> None:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    wanted = con.sql(sql)
    assert sorted(df.columns) == sorted(wanted.columns)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(wanted.columns, wanted.fetchall())
