"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from llm_rows import documents, rows

from slugmend.llm import spelling
from slugmend.llm.spelling import SpellingRules

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short, long = sorted((a, b), key=len)
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    return short[i + 1 :] == long[i + 1 :] if len(short) == len(long) else short[i:] == long[i + 1 :]


def brute(docs, rules=SpellingRules()):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % rules.typo_every else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    n = {w: c for w, c in n.items() if len(w) >= rules.min_length and c >= rules.min_count}
    sizes = {}
    for w in n:
        sizes.setdefault(len(w), []).append(w)
    near = {w: [v for k in (-1, 0, 1) for v in sizes.get(len(w) + k, ()) if one_edit(w, v)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= rules.ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def check(df, docs, rules=SpellingRules()):
    got = spelling.group_variants(df, rules)
    assert got.columns == COLUMNS
    want = brute(docs, rules)
    assert rows(got) == want
    return want


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    data = documents("/root/testdata/sf0.001", "doc_id, text")
    assert any(r[1] for r in check(docs, data))
    # more words and more lost code points
    assert check(docs, data, SpellingRules(min_length=5, min_count=4, ratio=2, typo_every=7))


def test_dense_words_and_long_chains(spark):
    """Short words of few letters (repeated letters, all kinds of edits), accents, and forms of forms."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("abéÿ×") for _ in range(rnd.choice((6, 7, 8)))) for _ in range(400)]
    text = " ".join(w for w in words for _ in range(rnd.choice((1, 2, 5, 9, 30))))
    chain = " ".join(" ".join(["qqqqqq" + "z" * i] * 2**i) for i in range(9))
    data = [(1, text), (2, text.upper()), (3, chain), (4, chain), (None, "aaaaaa")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    want = check(df, data, SpellingRules(min_count=2, ratio=2, typo_every=5))
    assert len({r[2] for r in want if r[0].startswith("qqqq")}) < 5
    check(df, data, SpellingRules(min_count=1, ratio=1000, typo_every=10**10))


def test_long_words(spark):
    """Beyond the length from which prefixes are hashed, and around it."""
    rnd = random.Random(2)
    words = []
    for size in (spelling.PLAIN - 1, spelling.PLAIN, spelling.PLAIN + 1, 500):
        base = "".join(rnd.choice("aé") for _ in range(size))
        for _ in range(12):
            at = rnd.randrange(size)
            words += [base, base[:at] + rnd.choice("abc") + base[at:], base[:at] + base[at + 1 :], base[:at] + "x" + base[at + 1 :]]
    data = [(1, " ".join(w for w in words for _ in range(rnd.choice((1, 3)))))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert max(r[4] for r in check(df, data, SpellingRules(min_count=1, ratio=2, typo_every=10**10))) > 20


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    data = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(clashing_docs, data)
    check(clashing_docs, data, SpellingRules(min_length=1, min_count=1, ratio=2, typo_every=2))
    check(no_docs, [])
