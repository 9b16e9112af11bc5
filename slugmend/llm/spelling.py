"""Spelling variant grouping by permuterm rotations.

A run is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased. So that the
grouping has variants to find, a run loses one code point where ``typo_every``
divides a checksum of its document's id and itself; see :func:`runs`. Words are the
distinct results of ``min_length`` code points and ``min_count`` occurrences or
more; two words are near if one code point inserted, deleted or replaced turns
one into the other. A word's form is its near word of most occurrences (ties: the
first in code-point order) if it has ``ratio`` times the word's own or more, and its
root is what the forms lead to in the end.

Method. A word with a terminator, ``uv$``, has the rotations ``v$u``. The rotation of
``u c v $`` that ends with ``c`` begins with the prefix ``v$u``; it is the prefix of

* every word ``u d v``, which differs from it in a replaced code point, and
* the whole rotation ``v$u`` of the word ``uv``, from which it differs by an inserted one.

So all rotations, whole ones and ones without their last code point, are sorted, and a
scan takes each group of equal prefixes: words that skip a code point there, all near
each other, and at most one whole word. A group has at most as many words as there are
code points in the alphabet, plus one, so none can be large. Each near pair meets in
one group only: a replacement has one place, and of an insertion into a stretch of
equal code points only the stretch's first place counts. The scan therefore gives each
word a count and its best neighbour there, and counts add up. No pair is written.
Words go about by number (in code-point order), long prefixes by hash.

Forms grow by ``ratio`` from word to word, so a chain has no more words than the
logarithm of the largest count, and roots follow by doubling steps.

Edge cases: null and empty texts have no run; a null ``doc_id`` counts as an empty
id; repeated rows count each; an empty table gives an empty result; further columns
are ignored; texts of any length are taken whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slugmend.llm.common import map_arrow, slices, texts_of
from slugmend.sources.cuts import materialise

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Stands in no word.
END = "$"
#: Words of a task that are counted before they are handed on.
_HELD = 1 << 18
_OUT_ROWS = 1 << 16
#: Longer prefixes are hashed: polynomials modulo a prime, at two places.
PLAIN = 64
_PRIME = (1 << 61) - 1
_BASES = (1_000_003_141_592_653, 2_000_002_718_281_828)


@dataclass(frozen=True)
class SpellingRules:
    min_length: int = 6
    min_count: int = 5
    ratio: int = 5
    typo_every: int = 199


def runs(doc_id: int | None, text: str, typo_every: int) -> Counter:
    """The runs of one document with their number; with ``h`` the checksum of ``<doc_id>:<run>``,
    a run whose ``h`` is divisible by ``typo_every`` loses its code point ``h % length``."""
    start = crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(_RUN.findall(text.translate(_LOWER))).items():
        h = crc32(run.encode(), start)
        if h % typo_every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def word_counts(docs: DataFrame, rules: SpellingRules) -> DataFrame:
    """``word``, ``n`` of every word."""

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                for word, n in runs(doc_id, text, rules.typo_every).items():
                    if len(word) >= rules.min_length:
                        held[word] += n
            if len(held) >= _HELD:
                yield batch_of(held)
                held.clear()
        if held:
            yield batch_of(held)

    found = docs.select("doc_id", "text").transform(map_arrow, run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= rules.min_count)


def numbered(words: DataFrame) -> DataFrame:
    """The words with a number ``id`` in code-point order, which stands for them in what is shuffled."""
    sorted_ = words.repartitionByRange("word").sortWithinPartitions("word")  # UTF-8 sorts as code points do
    return materialise(sorted_.withColumn("id", F.monotonically_increasing_id()), "words")


def prefixes(word: str) -> Iterator[tuple[str, int]]:
    """``(prefix, kind)`` of all rotations of ``word``: 0 a whole one, 1 one that skips the last code point,
    2 the same where that code point stands behind an equal one.

    Prefixes of more than ``PLAIN`` code points of a word are given by a hash of 122 bits,
    which follows from sums over the word's beginnings: a word of n costs n, not n squared.
    """
    n = len(word)
    whole, skip = _hashed(word) if n > PLAIN else ((lambda i: word[i:] + END + word[:i]), None)
    if skip is None or n - 1 <= PLAIN:
        skip = lambda i: word[i + 1 :] + END + word[:i]
    for i in range(n + 1):
        yield whole(i), 0
    for i, c in enumerate(word):
        yield skip(i), 2 if i and word[i - 1] == c else 1


def _hashed(word: str) -> tuple[Callable[[int], str], Callable[[int], str]]:
    """Functions that hash ``word[i:] + END + word[:i]``, and the same without ``word[i]``."""
    n, tables = len(word), []
    for base in _BASES:
        inverse = pow(base, -1, _PRIME)
        sums, powers, back = [0], [1], [1]
        for c in word:
            sums.append((sums[-1] + ord(c) * powers[-1]) % _PRIME)
            powers.append(powers[-1] * base % _PRIME)
            back.append(back[-1] * inverse % _PRIME)
        powers.append(powers[-1] * base % _PRIME)
        tables.append((sums, powers, back))

    def of(i: int, behind: int) -> str:
        values = (
            ((sums[n] - sums[behind]) * back[behind] + ord(END) * powers[n - behind] + sums[i] * powers[n - behind + 1]) % _PRIME
            for sums, powers, back in tables
        )
        return "#" + "".join(f"{v:016x}" for v in values)

    return lambda i: of(i, i), lambda i: of(i, i + 1)


def rotations(words: DataFrame) -> DataFrame:
    """``prefix``, ``id``, ``n``, ``kind`` of all rotations of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (
                (prefix, no, n, kind)
                for word, no, n in zip(*(batch.column(c).to_pylist() for c in ("word", "id", "n")), strict=True)
                for prefix, kind in prefixes(word)
            )
            while part := list(islice(rows, _OUT_ROWS)):
                yield _batch(part, {"prefix": pa.string(), "id": pa.int64(), "n": pa.int64(), "kind": pa.int32()})

    return words.select("word", "id", "n").transform(map_arrow, run, "prefix string, id long, n long, kind int")


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def _rank(member: tuple) -> tuple:
    _, no, n, _ = member
    return -n, no


def neighbours_in(group: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """``(id, near words, the best one's n, the best one)`` of the group's members that have a near word in it;
    members are rows of :func:`rotations` of one prefix."""
    skipping = sorted((m for m in group if m[3]), key=_rank)
    whole = [m for m in group if not m[3]]
    for i, (_, no, _, kind) in enumerate(skipping):
        # Beside itself every skipping word, and the whole one if this is the stretch's first place.
        near = skipping[1:2] if i == 0 else skipping[:1]
        near = near + (whole if kind == 1 else [])
        if near:
            best = min(near, key=_rank)
            yield no, len(skipping) - 1 + (len(whole) if kind == 1 else 0), best[2], best[1]
    for _, no, _, _ in whole:
        near = [m for m in skipping if m[3] == 1]
        if near:
            yield no, len(near), near[0][2], near[0][1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("prefix", "id", "n", "kind")
    rows = (row for b in slices(batches, _OUT_ROWS) for row in zip(*(b.column(c).to_pylist() for c in names), strict=True))
    groups = (list(members) for _, members in groupby(rows, key=lambda row: row[0]))
    found = (row for group in groups if len(group) > 1 for row in neighbours_in(group))
    while part := list(islice(found, _OUT_ROWS)):
        yield _batch(part, {"id": pa.int64(), "near": pa.int64(), "best_n": pa.int64(), "best": pa.int64()})


def nearest(words: DataFrame) -> DataFrame:
    """``id``, ``n_near`` and the near word of most occurrences (``best``, ``best_n``) of words that have one."""
    found = (
        rotations(words).repartition("prefix").sortWithinPartitions("prefix")
        .transform(map_arrow, _scan, "id long, near long, best_n long, best long")
    )
    first = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), first.alias("first")).select(
        "id", "n_near", F.col("first.best").alias("best"), (-F.col("first.less")).alias("best_n")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``id``, ``root`` of the words that have a form: each round doubles the length of the way followed."""
    ways = materialise(forms.select("id", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("id").alias("root"), F.col("root").alias("beyond"))
        further = materialise(
            ways.join(ahead, "root", "left").select("id", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")),
            "ways",
        )
        ways = further.select("id", "root")
        if further.filter("moved").isEmpty():
            return ways


def group_variants(docs: DataFrame, rules: SpellingRules = SpellingRules()) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word."""
    words = numbered(word_counts(docs, rules))
    best = F.col("best_n") >= rules.ratio * F.col("n")
    known = materialise(
        words.join(nearest(words), "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(best, F.col("best")).alias("form"), F.when(best, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(known.filter(F.col("form").isNotNull()).select("id", "form"))
    name = lambda no, word: words.select(F.col("id").alias(no), F.col("word").alias(word))
    # Only words with a form need the words behind numbers.
    with_form = materialise(
        roots.withColumnRenamed("root", "root_id").join(known.select("id", F.col("form").alias("form_id")), "id")
        .join(name("form_id", "form"), "form_id").join(name("root_id", "root"), "root_id").select("id", "form", "root"),
        "named",
    )
    return known.drop("form").join(with_form, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
