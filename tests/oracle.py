"""Runs a query's SQL on the same Parquet files and compares the rows, whatever their order."""

import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(sql: str, folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 1e9 else str(v)
    if hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def same(df, sql: str, folder: str):
    """None, or what differs."""
    names, want = rows_of(sql, folder)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    got = df.select(*sorted(df.columns)).collect()
    place = [names.index(c) for c in sorted(names)]
    a = sorted(tuple(plain(v) for v in r) for r in got)
    b = sorted(tuple(plain(r[k]) for k in place) for r in want)
    if len(a) != len(b):
        return f"{len(a)} rows and {len(b)}"
    return next((f"{x} and {y}" for x, y in zip(a, b) if x != y), None)
