"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return "NaN" if v != v else repr(round(v, 6) + 0.0)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return "NULL" if v is None else str(v)


def assert_same(spark, data: str, run, sql: str) -> None:
    df = run(spark, data)
    columns = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    db = duckdb.connect()
    for t in os.listdir(data):
        db.execute(f"create view {t.split('.')[0]} as from '{data}/{t}'")
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())
    assert ours == theirs
