"""Comparison of a query's rows with those of its SQL in DuckDB."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def sql_rows(sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = con.execute(sql)
    names = [c[0] for c in got.description]
    return names, got.fetchall()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def same(df, sql, sf):
    names, rows = sql_rows(sql, sf)
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in rows), key=repr)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    assert len(want) == len(got)
    assert want == got
    return len(want)
