"""Every registered query against its DuckDB statement at sf0.01 (the driver's gate)."""

from __future__ import annotations

import pytest
from compare import diff, duck, duck_rows, spark_rows
from data_dirs import SF_CHECK

import __spark_entry__ as E
from slugmend.plans import queries as Q

QUERIES = {k: v for k, v in E.queries().items() if k in Q.QUERIES}
SQL = {k: v for k, v in E.oracle_sql().items() if k in Q.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


# Spark type -> DuckDB type name, for the schema half of the check
TYPES = {
    "StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER", "BooleanType()": "BOOLEAN",
    "DoubleType()": "DOUBLE", "TimestampNTZType()": "TIMESTAMP", "TimestampType()": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_CHECK)
    spark_types = {f.name: TYPES.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert spark_types == duck_types
    got = spark_rows(df)
    exp = duck_rows(con, SQL[name])
    assert diff(got, exp) is None, diff(got, exp)
