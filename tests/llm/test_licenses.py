"""License scans: alignment against unbanded alignment, planted and damaged notices, candidates lose nothing."""

from __future__ import annotations

import random

import pytest
from llm_rows import documents

from slugmend.llm import licenses
from slugmend.llm.queries import QUERIES

INDEX = licenses.Index(licenses.TEMPLATES)


def full_alignment(text, template):
    """Most matched words of the best local alignment, without a band."""
    best = (0, 0)
    before = [(0, 0)] * (len(template) + 1)
    for w in text:
        now = [(0, 0)]
        for j, t in enumerate(template, 1):
            s, k = before[j - 1]
            cell = max((s + 2, k + 1) if w == t else (s - 1, k), (before[j][0] - 1, before[j][1]), (now[j - 1][0] - 1, now[j - 1][1]))
            now.append(cell if cell[0] > 0 else (0, 0))
            best = max(best, now[-1])
        before = now
    return best[1]


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_whole_templates(name):
    rows = INDEX.scan(f"Some text before. {licenses.TEMPLATES[name].upper()} And after.")
    assert [(r["template"], r["coverage"], r["first_word"]) for r in rows] == [(name, 1.0, 3)]


def test_damaged_notices():
    """A tenth of the words changed, left out or added: found, with the words that full alignment matches."""
    rnd = random.Random(11)
    for name in ("MIT/text", "Apache-2.0/notice", "GPL-3.0/notice", "BSD-3-Clause/text"):
        words = licenses.split_words(licenses.TEMPLATES[name])
        for _ in range(5):
            damaged = [x for w in words for x in rnd.choices(([w], ["zz"], [], [w, "yy"]), (90, 4, 3, 3))[0]]
            text = [f"q{rnd.randrange(500)}" for _ in range(80)]
            text[40:40] = damaged
            rows = [r for r in INDEX.scan(" ".join(text)) if r["template"] == name]
            assert len(rows) == 1 and abs(rows[0]["first_word"] - 40) <= 6
            assert rows[0]["matched_words"] == full_alignment(text, words)


def test_spans_and_repeats():
    text = "x " * 30 + "Released under the MIT License. " + "y " * 30 + "released under the mit license"
    rows = INDEX.scan(text)
    assert [text[r["first_char"] : r["end_char"]].lower() for r in rows] == ["released under the mit license"] * 2


def test_whole_table(spark):
    docs = documents("/root/testdata/sf0.01", "doc_id, text")
    got = QUERIES["op10_licenses"](spark, "/root/testdata/sf0.01").collect()
    lines = {n: " ".join(INDEX.words[i]) for i, n in enumerate(INDEX.names) if n.endswith("/line")}
    want = {(d, n) for d, t in docs for n, s in lines.items() if f" {s} " in f" {' '.join(licenses.split_words(t))} "}
    assert want and want <= {(r.doc_id, r.template) for r in got}
    assert all(r.coverage >= licenses.MIN_COVERAGE and r.first_word < r.end_word for r in got)


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    assert licenses.scan_documents(clashing_docs).collect() == []
    assert licenses.scan_documents(no_docs).count() == 0
    one = odd_docs.limit(1).selectExpr("cast(null as long) as doc_id", "'All rights reserved' as text")
    (row,) = licenses.scan_documents(one).collect()
    assert row.doc_id is None and row.license == "Proprietary"


def names(text):
    return [r["license"] for r in INDEX.scan(f"some words before {text} and some after")]


def test_licenses_of_one_family():
    cc = "This work is licensed under a Creative Commons Attribution{} {} License"
    assert names(cc.format("-NonCommercial", "4.0 International")) == ["CC-BY-NC-4.0"]
    assert names(cc.format("-NonCommercial-NoDerivatives", "4.0 International")) == ["CC-BY-NC-ND-4.0"]
    assert names(cc.format("-ShareAlike", "3.0 Unported")) == ["CC-BY-SA-3.0"] and names("licensed under CC BY 2.5") == ["CC-BY-2.5"]
    line = "This work is licensed under the GNU {}General Public License, version {}"
    for kind, version, name in (("Affero ", "3", "AGPL-3.0"), ("", "2", "GPL-2.0"), ("Lesser ", "2.1", "LGPL-2.1"), ("", "3", "GPL-3.0")):
        assert names(line.format(kind, version)) == [name]
        notice = licenses.TEMPLATES["GPL-3.0/notice"].replace("version 3", f"version {version}")
        for gnu in ("General\n        Public", "General Public"):
            notice = notice.replace(gnu, f"{kind}General Public")
        assert names(notice) == [name]
    assert names(line.format("", "7")) == [] and names("This work is licensed under the GNU General Public License") == []
    assert names(line.format("", "3.0")) == ["GPL-3.0"]
    bsd = licenses.TEMPLATES["BSD-3-Clause/whole"]
    assert names(bsd) == ["BSD-3-Clause"] and names(licenses.TEMPLATES["BSD-2-Clause/whole"]) == ["BSD-2-Clause"]


def test_whole_text_is_the_span():
    for name in ("MIT", "ISC", "BSD-3-Clause"):
        (row,) = INDEX.scan(licenses.TEMPLATES[f"{name}/whole"])
        assert row["template"] == f"{name}/whole" and (row["first_word"], row["end_word"]) == (0, row["template_words"])
