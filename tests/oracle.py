"""Spark results held against DuckDB's."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return bytes(v) if isinstance(v, bytearray) else v


def rows_of(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(plain(r[i]) for i in order) for r in found.fetchall())


def assert_same(df, con, sql: str) -> None:
    names, got = rows_of(df)
    want_names, want = sql_rows(con, sql)
    assert names == want_names
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])
