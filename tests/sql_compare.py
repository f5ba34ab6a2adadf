"""A query's rows against DuckDB's over the smallest tables."""

import os
from collections import Counter

DATA = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 6) if isinstance(v, float) else tuple(map(plain, v)) if isinstance(v, list | tuple) else v


def compare(spark, query, sql):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    df = query(spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want
