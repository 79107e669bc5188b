"""Compare registered queries with their SQL, as multisets of rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def as_rows(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    got_columns, got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want_columns, want = as_rows(names, cur.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows vs {sum(want.values())}; extra {sum(extra.values())}: "
            f"{[str(x)[:600] for x in list(extra)[:2]]}; missing {sum(missing.values())}: {[str(x)[:600] for x in list(missing)[:2]]}"
        )
    return None
