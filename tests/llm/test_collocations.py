"""Collocations against plain counting of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from llm_rows import documents

from slugmend.llm import collocations
from slugmend.llm.collocations import PhraseRules

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, rules):
    count, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            f = count.setdefault(lang, Counter())
            for m in range(1, rules.max_words + 1):
                f.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if a >= rules.min_count and len(p) > 1}
        inside = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                inside |= {p[i : i + m] for i in range(len(p) - m + 1) if f[p[i : i + m]] <= a}
        rows = []
        for p, a in found.items():
            if p not in inside:
                s, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[: rules.top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "rules",
    [
        PhraseRules(min_count=5, top=300),
        # small filters let infrequent prefixes pass, small groups extend prefixes, small buffers split the counts
        PhraseRules(min_count=8, top=50, filter_bits=16, group_load=200, buffer_words=3000),
        PhraseRules(min_count=20, top=2000, filter_bits=10, part_bits=4, group_load=20),
        PhraseRules(min_count=5, top=20, max_words=2),
    ],
)
def test_whole_table(spark, rules):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    want = brute(documents("/root/testdata/sf0.001", "lang, text"), rules)
    assert found(collocations.mine_phrases(docs, rules)) == want
    assert len(want) > 10


def test_hot_phrases_and_hot_words(spark):
    """A third of all positions begin with one word, pair or phrase; control characters are parts of words."""
    rnd = random.Random(3)
    data = []
    for i in range(300):
        w = []
        for _ in range(60):
            w += rnd.choice((["the"], ["the", "of"], ["the", "of", "all", "those", "things"], [rnd.choice("abcdé") + rnd.choice("xy\x01")], ["a."], ["a\x01"]))
        data.append((None if i % 9 == 0 else rnd.choice(("en", "de")), " ".join(w)))
    data.append(("en", "the " * 3000))
    df = spark.createDataFrame(data, "lang string, text string").repartition(4)
    for rules in (PhraseRules(min_count=10), PhraseRules(min_count=10, group_load=30, buffer_words=2000)):
        assert found(collocations.mine_phrases(df, rules)) == brute(data, rules)


def test_exact_products(spark):
    """Products beyond 64 bits."""
    n = 3 * 10**12
    words = spark.createDataFrame([("en", "x", n // 3), ("en", "y", n // 3 - 1), ("en", None, n)], "lang string, word string, f long")
    phrases = spark.createDataFrame([("en", "x y", 2, n // 3 - 2)], "lang string, phrase string, m int, f long")
    whole = collocations.phrase_counts
    try:
        collocations.phrase_counts = lambda *_: (words, phrases)
        row = collocations.mine_phrases(spark.createDataFrame([], "lang string, text string")).first()
    finally:
        collocations.phrase_counts = whole
    assert row.score == 1000 * (n // 3 - 2) * n // ((n // 3) * (n // 3 - 1))


def test_best_in_salted_parts(spark):
    rows = [("en", f"p{i:05}", i % 7, i % 11) for i in range(3000)] + [("de", "q", 1, 1)]
    df = spark.createDataFrame(rows, "lang string, phrase string, a long, score long")
    got = [(r.lang, r.rank, r.phrase) for r in collocations._best(df, 3).orderBy("lang", "rank").collect()]
    want = sorted((-s, -a, p) for lang, p, a, s in rows if lang == "en")[:3]
    assert got == [("de", 1, "q"), *(("en", i, p) for i, (_, _, p) in enumerate(want, 1))]


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    rules = PhraseRules(min_count=2)
    assert found(collocations.mine_phrases(clashing_docs, rules)) == brute([(r.lang, r.text) for r in odd_docs.collect()], rules)
    assert found(collocations.mine_phrases(no_docs, rules)) == []
