"""Run a query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value) -> str:
    if isinstance(value, float):
        return repr(value)
    return value.isoformat() if hasattr(value, "isoformat") else repr(value)


def differences(spark, con, query, sql: str, sf_dir: str) -> tuple[Counter, Counter]:
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = Counter(tuple(map(plain, row)) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    want = Counter(tuple(plain(row[k]) for k in place) for row in result.fetchall())
    return got - want, want - got
