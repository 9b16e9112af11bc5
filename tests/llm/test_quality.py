"""Quality rules against a plain re-statement of the contract."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from llm_rows import documents, rows

from slugmend.llm import quality
from slugmend.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    repeated = set()
    for i, w in enumerate(zip(found, found[1:], found[2:], strict=False)):
        if windows[w] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(found) < 50 or 100 * len(repeated) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


def verdicts(docs, rules):
    """kept by brute force over (doc_id, text, source)."""
    normal = lambda line: " ".join(re.sub("[0-9]+", "0", line.lower()).split())
    families, hosts = defaultdict(set), Counter()
    for _, text, source in docs:
        hosts[source] += 1
        own = {n: quality.line_hash(x) for x in (text or "").split("\n") if (n := normal(x))}
        for n, h in own.items():
            families[source, n].add(min((x for x in own.values() if x != h), default=0))
    out = []
    for _, text, source in docs:
        n, *_, failed = base(text)
        left = sum(
            len(WORD.findall(x))
            for x in (text or "").split("\n")
            if len(families[source, normal(x)]) <= max(rules.min_docs, rules.max_share * hosts[source])
        )
        out.append(not failed and left >= rules.min_left * n)
    return out


def check(df, docs, rules):
    want = [(d[0], *base(d[1]), k) for d, k in zip(docs, verdicts(docs, rules), strict=True)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert rows(df.select(*names)) == sorted(want, key=lambda r: [(x is not None, str(x)) for x in r])


def test_whole_table(spark):
    docs = documents("/root/testdata/sf0.01", "doc_id, text, source")
    check(QUERIES["op2_quality_rules"](spark, "/root/testdata/sf0.01"), docs, quality.QualityRules())


def test_frequent_lines_of_few_documents(spark):
    docs = documents("/root/testdata/sf0.01", "doc_id, text, source")
    rules = quality.QualityRules(min_docs=2, max_share=0.01)
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(quality.line_quality(df, rules), docs, rules)


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    rules = quality.QualityRules()
    check(quality.line_quality(clashing_docs, rules), [(r[0], r[1], r[3]) for r in odd_docs.collect()], rules)
    assert quality.line_quality(no_docs).count() == 0
    assert quality.filter_documents(no_docs).count() == 0


def test_boilerplate_goes_and_copies_stay(spark):
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    body = lambda i: " ".join(f"{letters(hash(i) % 10**6)}x{letters(j)}" for j in range(60))
    footer = "subscribe to our newsletter and follow us in 2024"
    data = [(i, f"{body(i)}\n{footer}", "h") for i in range(40)]  # a footer under 40 texts
    data += [(100 + i, f"{body('c')}\n{body('d')}", "h") for i in range(40)]  # 40 copies of one text
    data += [(200 + i, f"tiny{i} text\n" + "\n".join([footer] * 8), "h") for i in range(3)]  # little but the footer
    df = spark.createDataFrame(data, "doc_id long, text string, source string").selectExpr("*", "1 as n_chars")
    out = {r.doc_id: r for r in quality.filter_documents(df, quality.QualityRules()).collect()}
    assert set(out) == {*range(40), *range(100, 140)}
    assert all(out[i].text == body(i) and out[i].n_chars == len(body(i)) for i in range(40))
    assert all(out[i].text == f"{body('c')}\n{body('d')}" for i in range(100, 140))


def test_filter_keeps_columns(clashing_docs):
    out = quality.filter_documents(clashing_docs)
    assert out.schema == clashing_docs.schema
    out.collect()


def test_blocks_of_boilerplate(spark):
    """A block of 20 lines under 100 unrelated texts of one to three lines; copies, reordered too, count once."""
    letters = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    own = lambda i: "\n".join(f"own {letters(i)} line {letters(k)}" for k in range(1 + i % 3))
    block = [f"block line {letters(k)}" for k in range(20)]
    data = [(i, f"{own(i)}\n" + "\n".join(block), "h") for i in range(100)]
    data += [(1000 + i, f"{own(1000 + i)}\nfoot {letters(i % 20)}", "h") for i in range(400)]
    copied = ["copied one", "copied two", "copied three"]
    data += [(5000 + i, "\n".join(copied[:: 1 if i % 2 else -1]).upper(), "h") for i in range(9000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    (row,) = quality.frequent_lines(df, quality.QualityRules(min_docs=50)).collect()
    assert set(row.frequent) == {quality.line_hash(x) for x in block}
