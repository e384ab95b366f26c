"""Compare a registered query with its SQL twin: columns, rows and values, order aside."""

from __future__ import annotations

import datetime

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


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


def both(spark, con, query, sql, sf_dir):
    """Sorted columns and rows of each side, and our column types."""
    df = query(spark, sf_dir)
    ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return ours, _rows(names, found.fetchall()), dict(df.dtypes)


def difference(ours, theirs, show: int = 5) -> str:
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if ours[1] == theirs[1]:
        return ""
    mine, other = set(map(repr, ours[1])), set(map(repr, theirs[1]))
    return (
        f"{len(ours[1])} rows against {len(theirs[1])}\n ours only: "
        f"{sorted(mine - other)[:show]}\n theirs only: {sorted(other - mine)[:show]}"
    )
