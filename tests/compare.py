"""Run registered queries in Spark and DuckDB and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def differences(spark_df, con, sql: str) -> list:
    """Rows that differ; column order and row order do not matter."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(spark_df.columns), (sorted(names), sorted(spark_df.columns))
    order = sorted(names)
    want = sorted(
        (tuple(r[names.index(c)] for c in order) for r in result.fetchall()), key=_key
    )
    got = sorted((tuple(r[c] for c in order) for r in spark_df.collect()), key=_key)
    if len(want) != len(got):
        return [("rows", len(want), len(got))]
    return [
        (c, w, g)
        for wr, gr in zip(want, got)
        for c, w, g in zip(order, wr, gr)
        if not _same(w, g)
    ]
