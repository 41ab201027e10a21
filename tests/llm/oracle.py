"""Compares a registered query with its DuckDB SQL on the same tables."""

import os

import duckdb


def table(con, sf_dir, name):
    p = f"{sf_dir}/{name}.parquet"
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")


def same(spark, fn, sql, sf_dir, tables):
    con = duckdb.connect()
    for t in tables:
        table(con, sf_dir, t)
    got = fn(spark, sf_dir)
    rel = con.sql(sql)
    assert sorted(got.columns) == sorted(rel.columns)
    cols = sorted(rel.columns)
    key = lambda r: [(v is None, v) for v in r]
    want = sorted(rel.select(*cols).fetchall(), key=key)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == want
    return len(want)
