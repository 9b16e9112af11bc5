"""Line dedup against all pairs of lines."""

from __future__ import annotations

import random
import re

from llm_rows import documents, rows

from slugmend.llm import line_dedup
from slugmend.llm.queries import QUERIES
from slugmend.sources import cuts


def one_edit(a, b):
    """At most one word changed, left out or added."""
    if abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    if len(short) == len(long):
        return short[i + 1 :] == long[i + 1 :]
    return short[i:] == long[i + 1 :]


def brute(docs, rules=line_dedup.LineRules()):
    every, first = [], {}
    for i, text in docs:
        for n, line in enumerate((text.split("\n") if text is not None else [])):
            w = tuple(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
            if len(w) >= rules.min_words:
                place = (i is None, i or 0, n)
                every.append((i, n, w, place))
                first[w] = min(first.get(w, place), place)
    lengths = {}
    for w in first:
        lengths.setdefault(len(w), []).append(w)
    near = {}
    for w in first:
        if len(w) < rules.edit_words:
            continue
        found = [
            first[v]
            for n in (len(w) - 1, len(w), len(w) + 1)
            for v in lengths.get(n, ())
            if n >= rules.edit_words and v != w and first[v] < first[w] and one_edit(w, v)
        ]
        if found:
            near[w] = min(found)
    back = lambda p: (None if p[0] else p[1], p[2]) if p else (None, None)
    out = [(i, n, len(w), p == first[w] and w not in near, *back(first[w]), *back(near.get(w))) for i, n, w, p in every]
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def test_whole_table(spark):
    got = QUERIES["op9_line_dedup"](spark, "/root/testdata/sf0.001")
    assert rows(got) == brute(documents("/root/testdata/sf0.001", "doc_id, text"))


def test_near_lines(spark):
    """Many small edits of few lines: changes, left out and added words, at all positions, chains."""
    rnd = random.Random(5)
    data = []
    for i in range(250):
        w = [f"w{j}" for j in range(rnd.choice((7, 8, 9, 12)))]
        for _ in range(rnd.choice((0, 1, 1, 2))):
            at = rnd.randrange(len(w))
            rnd.choice((lambda: w.__setitem__(at, rnd.choice("xyz")), lambda: w.pop(at), lambda: w.insert(at, rnd.choice(("x", "w3")))))()
        data.append((rnd.randrange(200), " ".join(w) + "\n" + " ".join(w[::-1]).upper()))
    data = list({i: (i, t) for i, t in data}.values())
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert rows(line_dedup.decide_lines(df)) == brute(data)


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    assert rows(line_dedup.decide_lines(clashing_docs)) == brute([(r[0], r[1]) for r in odd_docs.collect()])
    assert line_dedup.decide_lines(no_docs).count() == 0 and line_dedup.drop_lines(no_docs).count() == 0


def test_half_line_hashes_are_gone_when_variants_are_made(spark, monkeypatch):
    """The tables that hold them are written without them and deleted before the largest joins."""
    held = []

    def variants(df, own=line_dedup._variants):
        held.extend(c for path in cuts.made(since) for c in spark.read.parquet(path).columns)
        return own(df)

    monkeypatch.setattr(line_dedup, "_variants", variants)
    since = cuts.mark()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert line_dedup.decide_lines(docs).count() > 0
    assert "copies" in held and "halves" not in held and "half" not in held


def test_drop_lines(odd_docs, clashing_docs):
    out = line_dedup.drop_lines(clashing_docs)
    assert out.schema.names == clashing_docs.schema.names
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[1]) == 2 and got[1][0].n_chars == 7  # repeated rows are one document, and keep what they had
    assert 2 not in got  # every line stands in document 1
    assert [r.text for r in got[3]] == [None] and [r.text for r in got[4]] == [""]
    assert got[6][0].text == "\nshort line" and got[6][0].n_chars == 11  # near-equal line
    assert got[10][0].text == "alpha beta gamma delta epsilon zeta eta theta"
    assert len(got[7]) == 1 and len(got[8]) == 1
