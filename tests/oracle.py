"""Compare a query with its SQL oracle on the same files."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in at) for row in rows]
    return sorted(plain, key=repr)


def compare(df, sql: str, con) -> tuple[bool, str]:
    columns = df.columns
    mine = rows_of(columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(columns) != sorted(names):
        return False, f"columns {sorted(columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return False, f"{len(mine)} rows, expected {len(theirs)}"
    for a, b in zip(mine, theirs):
        if repr(a) != repr(b):
            return False, f"{a} != {b}"
    return True, f"{len(mine)} rows"
