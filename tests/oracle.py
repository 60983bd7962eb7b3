"""Compares a query's rows with its SQL counterpart's, exactly."""

from pathlib import Path

import duckdb

DATA = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    if isinstance(x, bool) or x is None or isinstance(x, (int, str)):
        return str(x)
    return repr(float(x))


def compare(spark, query, sql, data=DATA):
    con = duckdb.connect()
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = query(spark, data)
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    columns = sorted(df.columns)
    assert columns == sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in got.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want
    return len(want)
