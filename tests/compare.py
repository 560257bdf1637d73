"""Runs a query and its DuckDB SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.sql(f"create view {t} as from read_parquet('{p + '/*.parquet' if os.path.isdir(p) else p}')")
    return con


def norm(v):
    return round(v, 6) if isinstance(v, float) else v


def compare(spark, sf_dir: str, query, sql: str) -> None:
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(norm(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    rel = connect(sf_dir).sql(sql)
    assert sorted(rel.columns) == cols, (sorted(rel.columns), cols)
    want = [tuple(norm(v) for v in r) for r in rel.select(", ".join(f'"{c}"' for c in cols)).fetchall()]
    assert len(got) == len(want), (len(got), len(want))
    a, b = sorted(map(repr, got)), sorted(map(repr, want))
    bad = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not bad, bad[:3]
