"""Token counts against the sentencepiece library."""

from __future__ import annotations

import random
import tracemalloc

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import documents, rows

from slugmend.llm import token_count
from slugmend.llm.queries import PIECE_BPE, QUERIES

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


@pytest.fixture(scope="module")
def own():
    with open(PIECE_BPE, "rb") as f:
        return token_count.counter(f.read())


PIECES = ["a", "s", "the", "ing", " ", "  ", "\n", "\t", "▁", "1", "é", "日", "\U0001d11e", "!", "''", "<s>", "</s>", "<0x41>", "\x00", "er", "    ", "ß", "ри", "=="]


def test_random_mixtures(own):
    rnd = random.Random(4)
    for _ in range(5000):
        text = "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 50)))
        assert own(text) == len(LIBRARY.encode(text)), text


def test_joined_pieces(own):
    rnd = random.Random(5)
    pieces = [LIBRARY.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    for _ in range(5000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8)))
        assert own(text) == len(LIBRARY.encode(text)), text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    with open(PIECE_BPE, "rb") as f:
        assert token_count.counter(f.read())(text) == len(LIBRARY.encode(text))


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_state_maps_compose(own, size, monkeypatch):
    """Chunks of any size give the same count, in any grouping."""
    text = "one  two   three\nfour, fivesix" * 5 + " " * 40 + "x" * 70
    marked = token_count.MARK + text.replace(" ", token_count.MARK)
    maps = [own.map_of(marked[i : i + size]) for i in range(0, len(marked), size)]
    while len(maps) > 1:  # a tree, not a chain
        maps = [own.compose(*maps[i : i + 2]) if len(maps[i : i + 2]) == 2 else maps[i] for i in range(0, len(maps), 2)]
    assert own.run(maps[0]) == len(LIBRARY.encode(text))
    monkeypatch.setattr(token_count, "CHUNK_CHARS", size)
    assert own(text) == len(LIBRARY.encode(text))


def test_a_long_text_without_a_space_takes_the_room_of_a_chunk(own):
    """Memory beside the text does not grow with it."""
    alphabet = [chr(c) for c in range(0x4E00, 0x4E00 + 97)] + ["a", "b", "。"]
    line = "".join(random.Random(6).choice(alphabet) for _ in range(50_000))
    peaks = []
    for times in (4, 40):
        text = line * times
        own(text[:200_000])  # tables are filled
        tracemalloc.start()
        got = own(text)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert got == len(LIBRARY.encode(text))
    assert peaks[1] < 1.5 * peaks[0] + 2**20 and peaks[1] < 2**24


def test_maps_of_other_entry_states(own):
    """A chunk's map asked for several states, before and after its tables restart."""
    marked = token_count.MARK + "the" * 30 + token_count.MARK + "windings" + "er" * 20
    want = own.run(own.map_of(marked))
    for cut in range(1, len(marked)):
        front, back = own.map_of(marked[:cut]), own.map_of(marked[cut:])
        state, count = front[token_count.START]
        own.transducer.restart()
        assert count + back[state][1] == want == own.run(own.compose(front, back))


def test_small_tables(own, monkeypatch):
    monkeypatch.setattr(token_count, "MAX_STATES", 20)
    monkeypatch.setattr(token_count, "CACHE_UNITS", 5)
    text = "a number of quite different words that do not fit the tables at all"
    assert own(text) == len(LIBRARY.encode(text))


def expected(docs):
    out = []
    for i, t in docs:
        n = len(LIBRARY.encode(t or ""))
        out.append((i, len((t or "").encode()), n, n > 4096))
    return sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def test_whole_table(spark):
    got = QUERIES["op3_token_counts"](spark, "/root/testdata/sf0.01")
    assert rows(got) == expected(documents("/root/testdata/sf0.01", "doc_id, text"))


def test_odd_rows(odd_docs, clashing_docs, no_docs):
    got = token_count.count_documents(clashing_docs, PIECE_BPE)
    assert rows(got) == expected([(r[0], r[1]) for r in odd_docs.collect()])
    assert token_count.count_documents(no_docs, PIECE_BPE).count() == 0
