"""Order-insensitive comparison of a Spark result with DuckDB on the same files."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql):
    got = bag(df.columns, [tuple(row) for row in df.collect()])
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    want = bag(names, result.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    return list((got - want).items())[:3], list((want - got).items())[:3], sum(want.values())
