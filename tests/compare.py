"""Comparing a Spark result with the result of the query's SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from datetime import date, datetime

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def rows_by_name(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark, db, run, sql: str, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    frame = run(spark, sf_dir)
    got = rows_by_name(frame.columns, [tuple(row) for row in frame.collect()])
    relation = db.sql(sql)
    want = rows_by_name(relation.columns, relation.fetchall())
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} != {sorted(relation.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "boolean": "BOOLEAN"}
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    types = {name: (kind, theirs[name]) for name, kind in frame.dtypes if kinds[kind] != theirs[name]}
    if types:
        return f"types {types}"
    if not want:
        return "no rows"
    if got != want:
        extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
        return (f"{sum(got.values())} rows against {sum(want.values())}, {sum((got - want).values())} differ;\n"
                f"spark {extra}\nsql   {lacking}")
    return ""
