"""LSH forest against all pairs of sets."""

from __future__ import annotations

import random
import re

from llm_rows import documents, rows

from slugmend.llm import lsh_forest
from slugmend.llm.lsh_forest import ForestRules


def set_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def brute(docs):
    sets = [set_of(t) for _, t in docs]
    distinct = sorted({s for s in sets if s}, key=len)
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, s in enumerate(distinct):
        for j in range(i - 1, -1, -1):
            if 100 * len(distinct[j]) < 80 * len(s):
                break
            both = len(s & distinct[j])
            if 100 * both >= 80 * (len(s) + len(distinct[j]) - both):
                parent[find(i)] = find(j)
    at, low = {s: i for i, s in enumerate(distinct)}, {}
    for (i, _), s in zip(docs, sets, strict=True):
        if s and i is not None:
            low[find(at[s])] = min(low.get(find(at[s]), i), i)
    out = []
    for (i, _), s in zip(docs, sets, strict=True):
        c = low.get(find(at[s])) if s else i
        out.append((i, len(s), c, i == c))
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def check(df, docs, rules=ForestRules()):
    got = lsh_forest.near_duplicates(df, rules)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(docs)
    assert rows(got) == want
    return want


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    check(docs, documents("/root/testdata/sf0.001", "doc_id, text"))


def test_groups_chains_and_templates(spark):
    """Near copies of one text that are not near each other, chains, and many texts that share most of their words.

    With regions of four classes nearly all of them are crowded, so the exact join decides."""
    rnd = random.Random(4)
    data = []

    def add(w):
        data.append((len(data), " ".join(w)))

    base = [f"b{i}" for i in range(120)]
    add(base)
    for _ in range(70):  # each two or three words away from the base
        w = list(base)
        for at in rnd.sample(range(120), rnd.choice((1, 2, 2, 3))):
            w[at] = f"n{rnd.randrange(10**6)}"
        add(w)
    w = [f"c{i}" for i in range(100)]
    for i in range(25):  # a chain: the ends share nothing
        w = [*w[4:], *(f"c{100 + 4 * i + j}" for j in range(4))]
        add(w)
    for i in range(60):  # one template with a quarter of own words
        add([*base[:75], *(f"t{i}x{j}" for j in range(25))])
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    check(df, data)
    check(df, data, ForestRules(region=4))


def test_a_crowded_group_is_not_paired_with_itself(spark, monkeypatch):
    """Near copies of one text, some of them just too far from all others: few pairs, and no link is lost."""
    rnd = random.Random(6)
    base, data = [f"b{i}" for i in range(150)], []
    for i in range(400):  # one to nine words changed: some are linked with many, some with none
        w = list(base)
        for at in rnd.sample(range(150), 1 if i < 300 else rnd.randint(5, 9)):
            w[at] = f"n{i}x{at}"
        data.append((i, " ".join(w)))
    for i in range(60):  # of other sizes: the front or the back is cut off
        w = base[rnd.randrange(40) :] if i % 2 else base[: 150 - rnd.randrange(40)]
        data.append((400 + i, " ".join([*w, f"e{i}"])))
    made = []

    def rarest(*args, own=lsh_forest._rarest):
        made.append(own(*args).cache())
        return made[-1]

    monkeypatch.setattr(lsh_forest, "_rarest", rarest)
    check(spark.createDataFrame(data, "doc_id long, text string").repartition(3), data, ForestRules(region=4))
    assert len(made) == 1 and made[0].count() < 20 * len(data)  # all pairs: 230 times


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    check(clashing_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])
    check(no_docs, [])
