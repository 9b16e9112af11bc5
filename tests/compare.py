"""Spark-vs-DuckDB result comparison used by the oracle tests.

Mirrors the driver's check: same row count, same column names, and the
same multiset of rows once columns are put in name order.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

from slugmend.sources.tables import TABLE_NAMES, table_path


def duck(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        path = table_path(data_dir, name)
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def normalise(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return normalise(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    return normalise(cols, cur.fetchall())


def diff(a: tuple[list[str], list[tuple]], b: tuple[list[str], list[tuple]], limit: int = 5) -> str | None:
    """None when equal, else a short description of the first differences."""
    if a[0] != b[0]:
        return f"columns differ: {a[0]} vs {b[0]}"
    if len(a[1]) != len(b[1]):
        extra_a = [r for r in a[1] if r not in set(b[1])][:limit]
        extra_b = [r for r in b[1] if r not in set(a[1])][:limit]
        return f"row counts {len(a[1])} vs {len(b[1])}; only spark {extra_a}; only duckdb {extra_b}"
    bad = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[:limit]}"
    return None
