"""Registered queries against their SQL, and the registration itself."""

from __future__ import annotations

import pytest
from compare import diff, duck, duck_rows, spark_rows

import __spark_entry__ as entry
from slugmend.llm.oracle import ORACLE_SQL
from slugmend.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    d = "/root/testdata/sf0.01"
    found = diff(spark_rows(QUERIES[name](spark, d)), duck_rows(duck(d), ORACLE_SQL[name]))
    assert found is None, found


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())
