"""Byte-level BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import documents, rows

from slugmend.llm import byte_bpe
from slugmend.llm.queries import BYTE_BPE, QUERIES


@pytest.fixture(scope="module")
def own():
    return byte_bpe.encoder(byte_bpe.read_vocabulary(BYTE_BPE))


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})


PIECES = ["a", "s", "t", "re", "ll", "'", " ", "  ", "\n", "\t", "　", " ", "1", "²", "é", "日", "\U0001d11e", "!", "''", "d", "'ve", "\x00", "\x1c", "́", "Ⅷ", "ǅ", "<|endoftext|>"]


def test_random_mixtures(own, library):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 60))) for _ in range(4000)]
    got = own.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [own.decode(x) for x in got] == [t.encode() for t in texts]


def test_every_code_point_class(own, library):
    texts = [f"a{c}a{c} 1{c}1 !{c}! {c} {c}\n{c}" for c in map(chr, [*range(0x3100), *range(0xA000, 0xD800, 7), *range(0x10000, 0x20000, 5)])]
    assert own.encode(texts) == library.encode_ordinary_batch(texts, num_threads=4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(texts):
    own = byte_bpe.encoder(byte_bpe.read_vocabulary(BYTE_BPE))
    got = own.encode(texts)
    assert [own.decode(x).decode() for x in got] == texts


def test_long_pieces(own, library):
    for text in ("a" * 5000, "ab" * 700 + " " * 900, "'s" * 300, "日" * 500):
        assert own.encode([text])[0] == library.encode_ordinary(text)


def test_small_cache(own, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_PIECES", 3)
    fresh = byte_bpe.Encoder(own.ranks)
    assert fresh.encode(["one two three four five six"])[0] == library.encode_ordinary("one two three four five six")


def expected(library, docs):
    out = []
    for i, t in docs:
        ids = library.encode_ordinary(t or "")
        digest = lambda b: hashlib.sha256(b).hexdigest()
        out.append((i, len(ids), digest(" ".join(map(str, ids)).encode()), digest((t or "").encode())))
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def test_whole_table(spark, library):
    got = QUERIES["op4_byte_bpe"](spark, "/root/testdata/sf0.01")
    assert rows(got) == expected(library, documents("/root/testdata/sf0.01", "doc_id, text"))


def test_odd_rows(library, odd_docs, clashing_docs, no_docs):
    assert rows(byte_bpe.encode_documents(clashing_docs, BYTE_BPE)) == expected(library, [(r[0], r[1]) for r in odd_docs.collect()])
    assert byte_bpe.encode_documents(no_docs, BYTE_BPE).count() == 0
    ids = byte_bpe.encode_documents(odd_docs, BYTE_BPE, with_ids=True).filter("doc_id = 10").first().ids
    assert library.decode(ids) == odd_docs.filter("doc_id = 10").first().text
