"""Order-insensitive comparison of a Spark result with DuckDB's on the same tables."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (int(v) if v == int(v) else v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in v.items())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def duck(sf_dir: str, sql: str):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    r = c.execute(sql)
    return [x[0] for x in r.description], r.fetchall()


def assert_same(df, sf_dir: str, sql: str) -> None:
    names, rows = duck(sf_dir, sql)
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    mine = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    theirs = sorted(repr(tuple(norm(r[names.index(c)]) for c in cols)) for r in rows)
    assert mine == theirs
