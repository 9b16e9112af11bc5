"""Toxicity: segments against all segments, held-out accuracy, planted passages."""

from __future__ import annotations

import random
import zlib

import pytest
from llm_rows import documents
from pyspark.sql import functions as F

from slugmend.llm import toxicity
from slugmend.llm.queries import QUERIES


def maximal(scores):
    """Maximal scoring segments by their definition: the best segment, then left and right of it."""
    best = None
    for i in range(len(scores)):
        total = 0.0
        for j in range(i, len(scores)):
            total += scores[j]
            key = (round(total, 9), -(j - i), -i)
            if total > 0 and (best is None or key > best[0]):
                best = (key, i, j + 1)
    if best is None:
        return []
    _, i, j = best
    left = maximal(scores[:i])
    right = [(a + j, b + j, s) for a, b, s in maximal(scores[j:])]
    return [*left, (i, j, sum(scores[i:j])), *right]


def test_segments():
    rnd = random.Random(2)
    for _ in range(300):
        scores = [rnd.choice((-1.0, -1.0, -1.0, 2.3, 1.17, 3.71)) for _ in range(rnd.randint(0, 40))]
        got = toxicity.segments([(i, s) for i, s in enumerate(scores) if s > 0], 1.0)
        assert [(a, b, pytest.approx(s)) for a, b, s in maximal(scores)] == got


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model).drop("passages").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = got[got.held_out].merge(labels.toPandas(), on="doc_id")
    right = both.predicted == both.toxic
    print(len(both), both.toxic.mean(), right.mean(), right[both.toxic == 1].mean(), right[both.toxic == 0].mean())
    assert right.mean() > 0.93 and right[both.toxic == 0].mean() > 0.97


def test_labels_of_held_out_rows_are_not_read(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def planted(rnd, toxic, n):
    words = [f"w{rnd.randrange(3000)}" for _ in range(n)]
    if toxic:
        at = rnd.randrange(n - 12)
        words[at : at + 12] = [w for _ in range(4) for w in (rnd.choice(("vile", "rotten", "filth")), rnd.choice(words), rnd.choice(words))]
    return " ".join(words)


def test_passages_in_long_texts(spark):
    """A short toxic passage anywhere in a long text is found; long clean texts stay clean."""
    rnd = random.Random(9)
    data = [(i, planted(rnd, i % 4 == 0, rnd.choice((60, 200, 5000)))) for i in range(800)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(800)], "doc_id long, toxic int")
    rows = toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()
    assert all(r.predicted == int(r.doc_id % 4 == 0) for r in rows)
    assert all(any(p.end - p.first <= 40 for p in r.passages) for r in rows if r.predicted)


def test_odd_rows(spark, odd_docs, clashing_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0), (7, 0), (8, 0)], "doc_id long, toxic int")
    for given in (labels, labels.filter("doc_id = 1"), labels.limit(0)):
        got = toxicity.score_documents(clashing_docs, toxicity.fit(clashing_docs, given)).collect()
        assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(no_docs, toxicity.fit(no_docs, labels)).count() == 0


def test_registered(spark):
    assert QUERIES["op8_toxicity"](spark, "/root/testdata/sf0.001").count() == len(documents("/root/testdata/sf0.001", "doc_id"))
