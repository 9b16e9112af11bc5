"""Exact top-k against all pairs in integers."""

from __future__ import annotations

import math
import random

import pytest
from llm_rows import documents, rows

from slugmend.llm import topk
from slugmend.llm.queries import QUERIES


def brute(vectors, k=10, every=100):
    use = {
        (i, tuple(math.floor(1024 * x) for x in v))
        for i, v in vectors
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, a in use:
        if q % every == 0:
            found = {(-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in use if i != q and len(a) == len(b)}
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def test_whole_table(spark):
    got = QUERIES["op7_topk"](spark, "/root/testdata/sf0.01")
    assert rows(got) == brute(documents("/root/testdata/sf0.01", "vec_id, embedding", "embeddings"))


@pytest.mark.parametrize("sizes", [(8, 4, 3), (64, 16, 8)])
def test_blocks_ties_and_lengths(spark, monkeypatch, sizes):
    """Small blocks, many equal scores, long and short vectors."""
    for name, n in zip(("CHUNK", "QUERIES", "RUN"), sizes, strict=True):
        monkeypatch.setattr(topk, name, n)
    rnd = random.Random(sizes[0])
    data = []
    for i in range(400):
        size = rnd.choice((0.01, 0.1, 1, 1, 5))
        data.append((i, [round(rnd.gauss(0, size), rnd.choice((0, 1, 4))) for _ in range(6)]))
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(5)
    assert rows(topk.top_k(df, every=10)) == brute(data, every=10)


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    data = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, [0.0, 0.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, []), (5, [None, 1.0]),
        (6, [inf, 1.0]), (7, [nan, 1.0]), (None, [1.0, 2.0]), (8, [1.0, 2.0, 3.0]), (200, [1.0, 1.0, 1.0]), (9, [-5.5, 1e5]),
        (300, [7.0]), (10, [3000.0, 1.0]), (11, [2.0**23, 3.0]),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as block", "2 as chunk", "3 as dim")
    assert rows(topk.top_k(df)) == brute(data)
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
