"""Queries against their SQL in DuckDB over one data folder."""

import glob
import math
import os


def connect(folder):
    import duckdb

    base = duckdb.connect()
    for p in glob.glob(f"{folder}/*.parquet"):
        base.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return base


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v + 0.0:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def same(spark, base, folder, query, sql):
    df = query(spark, folder)
    names = sorted(df.columns)
    want = base.sql(sql)
    assert sorted(want.columns) == names
    at = [want.columns.index(n) for n in names]
    a = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == b
