"""Run registered queries against DuckDB and compare the sorted rows."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else x
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, type(v).__name__, v if v is not None else 0) for v in r))


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows([d[0] for d in cur.description], cur.fetchall())


def difference(got, want) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    bad = [(g, w) for g, w in zip(got[1], want[1]) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        return f"{len(bad)} rows differ, first: {bad[0][0]} != {bad[0][1]}"
    return None
