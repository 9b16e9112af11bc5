"""Token counts by a compiled finite-state tokenizer.

The vocabulary of a byte-pair tokenizer (pieces that merge by score) is compiled
into a deterministic transducer over characters. Reading a character changes
the state and adds a number to the token count; no token is ever written out.

*Why a finite automaton does.* A sequence of tokens is the tokenizer's output
exactly if every token is its own encoding and every adjacent pair is what the
tokenizer makes of the two joined. So each prefix of a text has one last token,
and the last token after one more character is the one piece that ends there
and is compatible with the last token before it. Only pieces that are still
being spelled can matter later, so a state is: for each suffix of the text read
that begins some piece, the last token before that suffix and the count there,
relative to now. States are numbered as they are met (lazy determinisation);
each transition is annotated with the tokens it adds (which may be negative
when a merge swallows earlier tokens).

*Chunks.* A chunk of text is a state map, entry state -> (exit state, tokens
added), filled for the states that it is asked for. Maps compose associatively, by
states and numbers only; a prefix scan asks each chunk for the one state that
the chunks before it end in, and drops it, so a text of any length is counted in the
room of one chunk. Characters across which no piece reaches (a space mark after
other text, a character outside every piece) reset the automaton: what lies between
a chunk's first and last reset adds the same number whatever the entry state.

One map over the texts, no shuffle. Units between resets are cached by a worker
(bounded), and the transition table is bounded too; both restart when full.

Edge cases: null and empty texts have no tokens; control strings inside texts
are ordinary characters, as in the library's default; repeated rows give
repeated rows; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from slugmend.llm.common import map_arrow, slices, texts_of

#: The library's mark for a space.
MARK = "▁"
CHUNK_CHARS = 1 << 16
CACHE_UNITS = 400_000
MAX_STATES = 400_000


#: A state: (suffix, last token before it or "", tokens before it less tokens now), longest suffix first.
State = tuple[tuple[str, str, int], ...]
START: State = (("", "", 0),)


class Transducer:
    """States and annotated transitions of a vocabulary, compiled as they are met."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.letters = {c for piece in scores for c in piece}
        self.prefixes = {piece[:k] for piece in scores for k in range(1, len(piece))}
        self.pieces = {p for p in scores if len(p) == 1} | self.letters
        self.pieces |= {p for p in scores if len(p) > 1 and self.merge(p) == [p]}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.restart()

    def restart(self) -> None:
        self.states: list[State] = []
        self.numbers: dict[State, int] = {}
        self.steps: list[dict[str, tuple[int, int]]] = []
        self.number(START)

    def number(self, state: State) -> int:
        """The state's number in the tables; states outlive a restart of the tables, numbers do not."""
        found = self.numbers.get(state)
        if found is None:
            found = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        return found

    def merge(self, text: str) -> list[str]:
        """The tokenizer's own rule on a short string: the best-scored adjacent pair merges, leftmost first."""
        get, none = self.scores.get, float("-inf")
        parts = list(text)
        pairs = [get(text[i : i + 2], none) for i in range(len(text) - 1)]
        while pairs and (best := max(pairs)) > none:
            i = pairs.index(best)
            parts[i] = both = parts[i] + parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + both, none)
            if i < len(pairs):
                pairs[i] = get(both + parts[i + 1], none)
        return parts

    def compatible(self, a: str, b: str) -> bool:
        key = (a, b)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > CACHE_UNITS:
                self.pairs.clear()
            known = self.pairs[key] = not a or self.merge(a + b) == [a, b]
        return known

    def weight(self, token: str) -> int:
        """Tokens that a last token counts for: characters outside the vocabulary are one per byte."""
        return 1 if token in self.scores else len(token.encode())

    def step(self, state: int, char: str) -> tuple[int, int]:
        """(next state, tokens added) of one transition."""
        if char not in self.letters:
            return 0, len(char.encode())
        open_ = self.states[state]
        for suffix, last, before in open_:
            piece = suffix + char
            if piece in self.pieces and self.compatible(last, piece):
                token, added = piece, before + self.weight(piece)
                break
        else:
            raise ValueError(f"no piece ends in {char!r}")
        after = [
            (suffix + char, last, before - added) for suffix, last, before in open_ if suffix + char in self.prefixes
        ]
        return self.number((*after, ("", token, 0))), added

    def read(self, entry: State, text: str) -> tuple[State, int]:
        """(exit state, tokens added) of a text read from the entry state."""
        if len(self.states) > MAX_STATES:
            self.restart()
        state, total = self.number(entry), 0
        steps = self.steps
        for char in text:
            found = steps[state].get(char)
            if found is None:
                found = steps[state][char] = self.step(state, char)
            state, added = found
            total += added
        return self.states[state], total


class StateMap(dict[State, tuple[State, int]]):
    """Entry state -> (exit state, tokens added), filled by ``rule`` for the states that are asked for."""

    def __init__(self, rule: Callable[[State], tuple[State, int]]):
        super().__init__()
        self.rule = rule

    def __missing__(self, entry: State) -> tuple[State, int]:
        found = self[entry] = self.rule(entry)
        return found


class Counter(dict):
    """A worker's counter; the dict is the cache unit -> tokens."""

    def __init__(self, model: bytes):
        super().__init__()
        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = (library.is_byte, library.is_control, library.is_unknown, library.is_unused)
        scores = {
            library.id_to_piece(i): library.get_score(i)
            for i in range(library.get_piece_size())
            if not any(kind(i) for kind in special)
        }
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("pieces that reach across words are not supported")
        self.transducer = Transducer(scores)
        # Line ends are reset points of their own where no piece has one.
        breaks = "" if "\n" in self.transducer.letters else "\n"
        self.unit = re.compile(f"{MARK}*[^{MARK}{breaks}]+|{MARK}+" + ("|\n" if breaks else ""))

    def __missing__(self, unit: str) -> int:
        if len(self) >= CACHE_UNITS:
            self.clear()
        n = self.transducer.read(START, unit)[1]
        if len(unit) <= 256:
            self[unit] = n
        return n

    def total(self, text: str) -> int:
        return sum(map(self.__getitem__, self.unit.findall(text)))

    def map_of(self, chunk: str) -> StateMap:
        """The state map of a chunk of marked text."""
        read = self.transducer.read
        first, last = _first_reset(chunk), _last_reset(chunk)
        if first is None or last is None:
            return StateMap(lambda entry: read(entry, chunk))
        head, between, tail = chunk[: first + 1], chunk[first + 1 : last + 1], chunk[last + 1 :]

        def rule(entry: State) -> tuple[State, int]:
            leave, behind = read(START, tail)
            return leave, read(entry, head)[1] + self.total(between) + behind

        return StateMap(rule)

    def compose(self, a: StateMap, b: StateMap) -> StateMap:
        """a, then b."""

        def rule(entry: State) -> tuple[State, int]:
            middle, first = a[entry]
            leave, second = b[middle]
            return leave, first + second

        return StateMap(rule)

    def run(self, m: StateMap) -> int:
        """Tokens of a map entered in the start state."""
        return m[START][1]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if len(text) < CHUNK_CHARS:
            return self.total(MARK + text.replace(" ", MARK))
        state, tokens = self.map_of(MARK)[START]
        for i in range(0, len(text), CHUNK_CHARS):
            state, added = self.map_of(text[i : i + CHUNK_CHARS].replace(" ", MARK))[state]
            tokens += added
        return tokens


_RESET = re.compile(f"[^{MARK}](?={MARK})")


def _first_reset(chunk: str) -> int | None:
    """Where the first character stands that a space mark follows: the automaton resets behind it."""
    found = _RESET.search(chunk)
    return found.start() if found else None


def _last_reset(chunk: str) -> int | None:
    end = len(chunk)
    while (at := chunk.rfind(MARK, 0, end)) > 0:
        if chunk[at - 1] != MARK:
            return at - 1
        end = at
    return None


_COUNTERS: dict[int, Counter] = {}


def counter(model: bytes) -> Counter:
    """The worker's counter for a model file's content."""
    key = hash(model)
    if key not in _COUNTERS:
        _COUNTERS[key] = Counter(model)
    return _COUNTERS[key]


def count_documents(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` of every row's whole text."""
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(model)
        for batch in slices(batches):
            texts = texts_of(batch)
            tokens = [own(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").transform(map_arrow, run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
