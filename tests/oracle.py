"""Comparing a query with its SQL, as sets of rows with columns by name."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(folder, f"{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p / '*.parquet' if p.is_dir() else p}'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 6) if isinstance(value, float) else str(value)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


def same(con, df, sql: str) -> None:
    found = con.sql(sql)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(found.columns, found.fetchall())
