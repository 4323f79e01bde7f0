"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return value + 0.0
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(
        (tuple(plain(row[c]) for c in names) for row in df.collect()), key=lambda r: tuple(map(repr, r))
    )


def duck_rows(con, sql):
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(row[i]) for i in at) for row in found.fetchall()]
    return [columns[i] for i in at], sorted(rows, key=lambda r: tuple(map(repr, r)))


def difference(df, con, sql):
    """None when both agree, else a short description."""
    names, mine = spark_rows(df)
    other_names, other = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(mine) != len(other):
        return f"{len(mine)} rows != {len(other)} rows; {mine[:2]} / {other[:2]}"
    off = [(a, b) for a, b in zip(mine, other) if a != b]
    if off:
        return f"{len(off)} of {len(mine)} rows differ: {off[:2]}"
    types = [type(v) for v in mine[0]] if mine else []
    other_types = [type(v) for v in other[0]] if other else []
    clash = [n for n, a, b in zip(names, types, other_types) if a != b and type(None) not in (a, b)]
    return f"types differ in {clash}" if clash else None
