"""The pipeline: stages keep their contract, and catch planted cases."""

from __future__ import annotations

import corpus_pipeline

from slugmend.llm import graph
from slugmend.sources.cuts import materialise


def test_stages(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, d), name)
        assert docs.columns == columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert last.count() == docs.count()
    got = corpus_pipeline.run(spark, d)
    pick = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(got.select(pick).collect()) == sorted(last.select(pick).collect())


def test_near_duplicate_stage_leaves_no_shuffle_files(spark, monkeypatch):
    """Only the counts of the components' rounds leave some, of a few rows."""

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("\n")
        return {b.split("_")[1] for b in blocks.split("\n") if b.startswith("shuffle_")}

    def unsettled(edges, own=graph._unsettled):
        before = shuffles()
        found = own(edges)
        counted.update(shuffles() - before)
        return found

    had, counted = shuffles(), set()
    monkeypatch.setattr(graph, "_unsettled", unsettled)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(3)
    corpus_pipeline.near_duplicates_stage(spark, docs, "")
    assert counted and not shuffles() - had - counted


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    for start in (odd_docs, clashing_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, ""), name)


def test_copies_go_and_clean_documents_stay(spark):
    """Unrelated texts stay whole; of exact copies and near copies one stays."""
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    text = lambda i: [f"{letters(i)}z{letters(j * 7919 % 1009)}" for j in range(120)]
    data = [(i, " ".join(text(i)), "en", f"s{i % 3}", 1) for i in range(60)]
    data += [(100 + i, " ".join(text(7)), "en", f"s{i % 3}", 1) for i in range(30)]  # exact copies of 7
    for i in range(10):  # near copies of 8: two words changed, on lines of their own
        w = text(8)
        w[3 * i], w[60 + i] = "changed", "words"
        data.append((200 + i, " ".join(w), "en", "s1", 1))
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = materialise(stage(spark, docs, ""), name)
    got = {r.doc_id: r.text for r in docs.collect()}
    assert {i: got.get(i) for i in range(60)} == {i: " ".join(text(i)) for i in range(60)}
    assert not any(100 <= i < 130 for i in got)
