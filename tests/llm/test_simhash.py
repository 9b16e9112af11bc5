"""SimHash near-dedup against all pairs and plain integers."""

from __future__ import annotations

import random
import re

import xxhash
from llm_rows import documents, rows

from slugmend.llm import simhash
from slugmend.llm.queries import QUERIES


def print_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, bits=4):
    """Smallest reachable member by comparing all pairs of distinct fingerprints."""
    distinct = sorted(set(prints))
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, a in enumerate(distinct):
        for j in range(i):
            if (a ^ distinct[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return {a: find(i) for i, a in enumerate(distinct)}


def brute(docs):
    prints = [print_of(t) for _, t in docs]
    root = roots(prints)
    low = {}
    for (i, _), p in zip(docs, prints, strict=True):
        if i is not None:
            low[root[p]] = min(low.get(root[p], i), i)
    return sorted(
        ((i, f"{p:016x}", low.get(root[p])) for (i, _), p in zip(docs, prints, strict=True)),
        key=lambda r: [(x is not None, str(x)) for x in r],
    )


def test_whole_table(spark):
    got = QUERIES["op6_simhash"](spark, "/root/testdata/sf0.001")
    assert rows(got) == brute(documents("/root/testdata/sf0.001", "doc_id, text"))


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    assert rows(simhash.link_documents(clashing_docs)) == brute([(r[0], r[1]) for r in odd_docs.collect()])
    assert simhash.link_documents(no_docs).count() == 0
    assert simhash.one_per_component(no_docs).count() == 0


def test_chains_and_dense_clusters(spark):
    """Random fingerprints, chains of four-bit steps and balls of hundreds of members."""
    rnd = random.Random(7)
    prints = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(6):  # chains
        p = rnd.getrandbits(64)
        for _ in range(20):
            for b in rnd.sample(range(64), rnd.choice((3, 4, 4, 5))):
                p ^= 1 << b
            prints.add(p)
    for size in (400, 60):  # balls
        centre = rnd.getrandbits(64)
        for _ in range(size):
            p = centre
            for b in rnd.sample(range(64), rnd.randint(1, 7)):
                p ^= 1 << b
            prints.add(p)
    signed = lambda p: p - (1 << 64) if p >> 63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {r.node: r.root for r in simhash.link_fingerprints(df).collect()}
    want, classes = roots(prints), {}
    for p in prints:
        classes.setdefault(want[p], set()).add(signed(p))
    found = {}
    for p in prints:
        found.setdefault(got.get(signed(p), signed(p)), set()).add(signed(p))
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, found.values()))


def test_one_per_component(odd_docs, clashing_docs):
    want = brute([(r[0], r[1]) for r in odd_docs.collect()])
    got = simhash.one_per_component(clashing_docs)
    assert got.schema.names == clashing_docs.schema.names
    ids = [r.doc_id for r in got.collect()]
    classes = {(p, c) for _, p, c in want if c is not None}
    assert sorted(x for x in ids if x is not None) == sorted({c for _, c in classes})
    assert ids.count(None) == len({p for i, p, c in want if c is None})
