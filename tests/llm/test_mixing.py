"""Mixing: targets by the stated rounds, exact quotas, the hypergeometric law, words near their targets."""

from __future__ import annotations

import re
from collections import defaultdict
from math import comb

import pytest
from llm_rows import documents, rows
from pyspark.sql import functions as F

from slugmend.llm import mixing
from slugmend.llm.queries import QUERIES


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Targets by rounds: share, stop at three times, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return out | share
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= above
    return out


def check(got, docs, near):
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += size_of(t)
    want = targets(sizes)
    by_target, by_size = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.taken == r.size * len(r.shards) and len(r.shards) <= 3
        assert all(0 <= x < 16 for x in r.shards)
    source = defaultdict(list)
    for i, t, s in docs:
        source[i, size_of(t)].append(s)
    for r in got:
        s = source[r.doc_id, r.size]
        assert any(r.source_size == sizes[x] and r.target == pytest.approx(want[x]) for x in s)
        by_target[s[0]] += r.taken
        by_size[s[0]] += r.size
    for s, t in want.items():
        assert abs(by_target[s] - t) <= near, (s, by_target[s], t)


def test_whole_table(spark):
    docs = documents("/root/testdata/sf0.01", "doc_id, text, source")
    got = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    longest = max(size_of(t) for _, t, _ in docs)
    check(got, docs, longest)
    again = QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    got = mixing.mix_documents(clashing_docs)
    assert got.count() == odd_docs.count()
    want = sorted((str(r.doc_id), size_of(r.text)) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r["size"]) for r in got.collect()) == want
    assert mixing.mix_documents(no_docs).count() == 0 and mixing.mix_rows(no_docs).count() == 0
    out = mixing.mix_rows(clashing_docs)
    assert out.schema.names == clashing_docs.schema.names
    taken = {str(r.doc_id): len(r.shards) for r in got.collect() if r.doc_id not in (1, None)}
    counts = {str(r.doc_id): r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {k: counts.get(k, 0) for k in taken} == taken


def test_all_sources_empty(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert rows(mixing.mix_documents(df).select("doc_id", "size", "target", "taken")) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_hypergeometric_law(spark):
    """The inverse distribution function against exact binomials, on a grid of u."""
    cases = [(7, 20, 9), (0, 10, 4), (10, 10, 4), (5, 30, 30), (400, 1000, 500), (3, 900, 450), (1, 2, 1)]
    grid = [(g, n, d, (i + 0.5) / 4000) for g, n, d in cases for i in range(4000)]
    df = spark.createDataFrame(grid, "good long, total long, drawn long, u double")
    k = mixing.hypergeometric(F.col("u"), F.col("good"), F.col("total"), F.col("drawn"))
    got = df.withColumn("k", k).groupBy("good", "total", "drawn", "k").count().collect()
    for g, n, d in cases:
        seen = {r.k: r["count"] / 4000 for r in got if (r.good, r.total, r.drawn) == (g, n, d)}
        law = {x: comb(g, x) * comb(n - g, d - x) / comb(n, d) for x in range(max(0, d + g - n), min(g, d) + 1)}
        assert set(seen) <= set(law)
        assert max(abs(seen.get(x, 0) - p) for x, p in law.items()) < 1e-3


@pytest.mark.parametrize("shards", [1, 2, 7, 16])
def test_tree_is_exact(spark, shards):
    quotas = {"a": 5, "b": 0, None: 1234, "c": 77}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    got = {r.source: r.lasts for r in mixing.split_quotas(df, mixing.Mix(shards=shards)).collect()}
    sizes = [0] * shards
    for s, q in quotas.items():
        assert len(got[s]) == shards and got[s][-1] == q and got[s] == sorted(got[s])
        for i in range(shards):
            sizes[i] += got[s][i] - (got[s][i - 1] if i else 0)
    assert max(sizes) - min(sizes) <= shards.bit_length() and sum(sizes) == sum(quotas.values())


def test_one_source_holds_most(spark):
    data = [(i, "w " * (i % 37 + 1), "big") for i in range(3000)] + [(5000 + i, "w " * 40, "small") for i in range(20)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix_documents(df).collect()
    check(got, data, 40)
