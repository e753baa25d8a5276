"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows), key=lambda r: [str(v) for v in r]
    )


TYPES = {
    "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "INTEGER": "int",
}


def compare(spark, query, sql, folder):
    """(seconds, number of rows, problem or None)"""
    start = time.time()
    frame = query(spark, folder)
    got = [tuple(r) for r in frame.collect()]
    seconds = time.time() - start
    if sql is None:
        return seconds, len(got), None
    con = connect(folder)
    relation = con.sql(sql)
    names, kinds = list(relation.columns), [str(t) for t in relation.types]
    expected = relation.fetchall()
    if sorted(names) != sorted(frame.columns):
        return seconds, len(got), f"columns {frame.columns} / {names}"
    theirs = {n: TYPES.get(k, k) for n, k in zip(names, kinds)}
    mine = dict(frame.dtypes)
    if mine != theirs:
        return seconds, len(got), f"types {[(n, mine[n], theirs[n]) for n in mine if mine[n] != theirs[n]]}"
    a, b = rows_of(frame.columns, got), rows_of(names, expected)
    if a == b:
        return seconds, len(got), None
    mine_only, theirs_only = set(a) - set(b), set(b) - set(a)
    return seconds, len(got), (
        f"{len(a)} / {len(b)} rows, only here {list(mine_only)[:2]}, only there {list(theirs_only)[:2]}"
    )
