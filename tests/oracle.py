"""Compare a query with its SQL on DuckDB, as sets of rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6) if math.isfinite(value) else str(value)
    return value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def same(frame, con, sql):
    columns = sorted(frame.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in frame.collect()]
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    want = [tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
    assert ordered(got) == ordered(want)
