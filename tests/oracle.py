"""Compares a registered query with its SQL twin on the same tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if hasattr(value, "is_finite"):
        return round(float(value), 6)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise what differs."""
    frame = build(spark, sf_dir)
    mine = [tuple(row) for row in frame.collect()]
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    types = {d[0]: str(d[1]).lower() for d in cursor.description}
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    for name, kind in frame.dtypes:
        sql_kind = {"integer": "int", "varchar": "string"}.get(types[name], types[name])
        if kind != sql_kind and not kind.startswith("timestamp"):
            return f"type of {name}: {kind} != {sql_kind}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(_sorted_rows(frame.columns, mine), _sorted_rows(columns, theirs)):
        if a != b:
            return f"first difference:\n  spark  {a!r:.400}\n  duckdb {b!r:.400}"
    return None
