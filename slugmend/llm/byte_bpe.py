"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

*Pre-tokenisation without regex.* A batch of texts is one array of code
points. Each point becomes a symbol: its class (letter, number, space, other
white space, apostrophe, other) refined by what follows it (is the next point
white space, does a contraction follow the apostrophe). With that look-ahead
in the symbol, the published pattern is a deterministic automaton of eight
states: whether a piece starts at a point depends on the symbol and the state
alone. Every symbol is a function from states to states; functions compose
associatively, so the states before all points come from a prefix scan: rows
of ``ROW`` points are composed in lockstep, row functions are scanned by
doubling, and a second lockstep pass emits the starts. The first point of a
text maps every state to the start state, so texts do not touch.

*Merging.* Each piece is encoded once per worker and cached (bounded): the
lowest-ranked adjacent pair merges first, leftmost among equals, with a heap,
so that one piece of a whole text's length costs n log n.

*Decoding.* Token ids index the vocabulary's byte strings; offsets of the
pieces in the text are available from ``piece_offsets``.

No shuffle: one map over the texts, any batch size, memory bounded by a slice
of rows. The vocabulary file is read on the driver (its path is a parameter)
and shipped with the function.

Edge cases: null is the empty text, which has no tokens, and the hashes of
the empty string; repeated rows give repeated rows; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from slugmend.llm.common import map_arrow, slices, texts_of

# Classes of code points.
OTHER, LETTER, NUMBER, BLANK, WHITE, QUOTE = range(6)
# States: what the piece that is open at a point is.
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_WHITE, AFTER_BLANK, ONE_MORE, TWO_MORE = range(8)
STATES = 8
# Symbols beyond the classes: white space with more white space (or the end) after it,
# and an apostrophe that a contraction of one or two letters follows.
MORE_WHITE, QUOTE_ONE, QUOTE_TWO = 6, 7, 8
SYMBOLS = 9

#: Points of a row that is run in lockstep with the other rows of a batch.
ROW = 128
#: Pieces kept in a worker's cache before it is emptied.
CACHE_PIECES = 400_000
#: Bytes up to which a piece is merged without a heap.
SHORT_PIECE = 48

# White_Space of the Unicode character database (fixed values).
_WHITE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters after an apostrophe that are pieces of their own (fixed values of the published pattern).
_ONE = "stmd"
_TWO = ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(0x110000, dtype=np.uint8)
    points = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    for what, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        found = "".join(regex.findall(pattern, points))
        out[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = what
    out[_WHITE] = WHITE
    out[32] = BLANK
    out[ord("'")] = QUOTE
    return out


@lru_cache(maxsize=1)
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a piece starts, by (symbol, state); symbols + SYMBOLS are first in their text."""
    step = np.zeros((2 * SYMBOLS, STATES), dtype=np.uint8)
    starts = np.zeros((2 * SYMBOLS, STATES), dtype=bool)
    joins = {  # symbol: (states whose piece goes on, state after)
        LETTER: ((IN_LETTERS, AFTER_BLANK), IN_LETTERS),
        NUMBER: ((IN_NUMBERS, AFTER_BLANK), IN_NUMBERS),
        OTHER: ((IN_OTHER, AFTER_BLANK), IN_OTHER),
        QUOTE: ((IN_OTHER, AFTER_BLANK), IN_OTHER),
        QUOTE_ONE: ((IN_OTHER, AFTER_BLANK), IN_OTHER),
        QUOTE_TWO: ((IN_OTHER, AFTER_BLANK), IN_OTHER),
        MORE_WHITE: ((IN_WHITE,), IN_WHITE),
        BLANK: ((), AFTER_BLANK),
        WHITE: ((), START),
    }
    opened = {QUOTE_ONE: ONE_MORE, QUOTE_TWO: TWO_MORE}
    for symbol, (go_on, after) in joins.items():
        for state in range(STATES):
            joined = state in go_on
            starts[symbol, state] = not joined
            step[symbol, state] = after if joined else opened.get(symbol, after)
    for state, after in ((ONE_MORE, START), (TWO_MORE, ONE_MORE)):  # the letters of a contraction
        starts[LETTER, state] = False
        step[LETTER, state] = after
    step[SYMBOLS:] = step[:SYMBOLS, START : START + 1]
    starts[SYMBOLS:] = True
    return step, starts


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of code points; ``first``: positions at which a text starts."""
    kind = classes()[points]
    n = len(points)
    is_first = np.zeros(n + 3, dtype=bool)
    is_first[first] = True
    is_first[n:] = True

    def ahead(values: np.ndarray, by: int, fill: int) -> np.ndarray:
        """Values ``by`` points on, ``fill`` where the text ends before."""
        out = np.full(n, fill, dtype=values.dtype)
        out[: n - by] = values[by:]
        for k in range(1, by + 1):
            out[is_first[k : n + k]] = fill
        return out

    white = (kind == BLANK) | (kind == WHITE)
    out = kind.copy()
    out[white & (ahead(white, 1, True))] = MORE_WHITE
    quote = np.flatnonzero(kind == QUOTE)
    if len(quote):
        one, two = ahead(points, 1, 0)[quote], ahead(points, 2, 0)[quote]
        out[quote[np.isin(one, [ord(c) for c in _ONE])]] = QUOTE_ONE
        for a, b in _TWO:
            out[quote[(one == ord(a)) & (two == ord(b))]] = QUOTE_TWO
    out[first] += SYMBOLS
    return out


def piece_starts(symbol: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each point, by a prefix scan of the symbols' state functions."""
    step, starts = automaton()
    n = len(symbol)
    rows = -(-n // ROW)
    grid = np.full(rows * ROW, MORE_WHITE, dtype=np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T)
    # Function of every row: the state after it for each state before it.
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for column in grid:
        whole = step[column[:, None], whole]
    # Inclusive scan by doubling; composition is associative.
    by = 1
    while by < rows:
        whole[by:] = np.take_along_axis(whole[by:], whole[:-by].copy(), axis=1)
        by *= 2
    state = np.full(rows, START, dtype=np.uint8)
    state[1:] = whole[:-1, START]
    out = np.empty((ROW, rows), dtype=bool)
    for i, column in enumerate(grid):
        out[i] = starts[column, state]
        state = step[column, state]
    return out.T.reshape(-1)[:n]


def piece_offsets(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts' bytes in one string, the byte offset of every piece (and the end), and each text's first piece (and the end)."""
    whole = "".join(texts)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths)
    if not len(whole):
        return b"", np.zeros(1, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
    points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
    first = (ends - lengths)[lengths > 0]
    starts = np.flatnonzero(piece_starts(symbols(points, first)))
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    at = np.concatenate([[0], np.cumsum(width)])
    bounds = np.concatenate([at[starts], at[-1:]])
    return whole.encode(), bounds, np.searchsorted(starts, np.concatenate([[0], ends]))


class Encoder(dict):
    """Cache of a worker: piece -> token ids. Missing pieces are merged by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.numbers = [str(i) for i in range(len(self.tokens))]

    def __missing__(self, piece: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE_PIECES:
            self.clear()
        whole = self.ranks.get(piece)
        if whole is not None:
            ids = (whole,)
        else:
            ids = self.merge_short(piece) if len(piece) <= SHORT_PIECE else self.merge(piece)
        if len(piece) <= 256:
            self[piece] = ids
        return ids

    def merge_short(self, piece: bytes) -> tuple[int, ...]:
        """Merges by scanning the pairs' ranks, which is fastest for a word."""
        get, none = self.ranks.get, len(self.tokens)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [get(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < none:
            i = pairs.index(low)
            parts[i] = both = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + both, none)
            if i < len(pairs):
                pairs[i] = get(both + parts[i + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Merges with a heap, so that a very long piece costs n log n."""
        ranks, n = self.ranks, len(piece)
        after = list(range(1, n + 1))  # start of the next part
        before = list(range(-1, n - 1))
        alive = [True] * n

        def rank(i: int) -> int | None:
            j = after[i]
            return ranks.get(piece[i : after[j]]) if j < n else None

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or (j := after[i]) >= n or after[j] != end:
                continue  # one of the two parts has merged since
            alive[j] = False
            after[i] = end
            if end < n:
                before[end] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k, after[after[k]]))
        return tuple(ranks[piece[i : after[i]]] for i in range(n) if alive[i])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text."""
        whole, bounds, of_text = piece_offsets(texts)
        cut, upto = bounds.tolist(), of_text.tolist()
        out = []
        for a, b in zip(upto, upto[1:], strict=False):
            pieces = [whole[i:j] for i, j in zip(cut[a:b], cut[a + 1 : b + 1], strict=True)]
            out.append(list(chain.from_iterable(map(self.__getitem__, pieces))))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_ENCODERS: dict[int, Encoder] = {}


def encoder(vocabulary: bytes) -> Encoder:
    """The worker's encoder for a vocabulary file's content (base64 token and rank a line)."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder({base64.b64decode(t): int(r) for t, r in map(bytes.split, vocabulary.splitlines()) if t})
    return _ENCODERS[key]


def read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, vocabulary_path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` (and ``ids``) of every row's whole text."""
    vocabulary = read_vocabulary(vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        numbers = own.numbers
        for batch in slices(batches, 64):
            ids = own.encode(texts_of(batch))
            columns = [
                batch.column(0),
                pa.array(list(map(len, ids)), pa.int64()),
                pa.array([hashlib.sha256(" ".join([numbers[i] for i in x]).encode()).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids]),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").transform(map_arrow, run, schema + ", ids array<int>" * with_ids)
