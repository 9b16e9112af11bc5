"""Rows of the generated tables, read without Spark."""

from __future__ import annotations

import duckdb


def documents(sf_dir, columns, table="documents"):
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()


def rows(df):
    """Rows as a sorted list of tuples; null sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(x)) for x in r])
