"""Runs registered queries next to their check SQL and compares whole results."""

from __future__ import annotations

import datetime
import decimal
import math
import time

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """A DuckDB session with the driver tables as views."""
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(str, map(_plain, value))) + "]"
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, folder):
    """Status line and whether the query agrees with its SQL (or merely runs, without SQL)."""
    started = time.time()
    frame = fn(spark, folder)
    got = [tuple(r) for r in frame.collect()]
    seconds = time.time() - started
    if sql is None:
        return bool(got), f"{name}: rows only, {len(got)} rows, {seconds:.1f}s"
    relation = con.sql(sql)
    want_names, want = relation.columns, relation.fetchall()
    if sorted(frame.columns) != sorted(want_names):
        return False, f"{name}: columns {sorted(frame.columns)} / {sorted(want_names)}"
    left, right = _rows(frame.columns, got), _rows(want_names, want)
    if left != right:
        only_left = [r for r in left if r not in set(right)][:2]
        only_right = [r for r in right if r not in set(left)][:2]
        return False, f"{name}: {len(left)}/{len(right)} rows differ: {str(only_left)[:400]} / {str(only_right)[:400]}"
    types = {c: t for c, t in frame.dtypes}
    odd = [(c, types[c], str(t)) for c, t in zip(want_names, relation.types) if not _same_type(types[c], str(t))]
    return not odd, f"{name}: {len(left)} rows equal, {seconds:.1f}s" + (f" but types {odd}" if odd else "")


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT"}


def _same_type(ours: str, theirs: str) -> bool:
    return ours not in _TYPES or _TYPES[ours] == theirs
