"""Phrase collocation mining by vertically partitioned, depth-truncated suffix subtrees.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces
into words at space and tab. Everything is counted per language (null: ``und``).
A phrase of 2 to ``max_words`` words that occurs ``min_count`` times or more within
pieces is a candidate, with ``a`` occurrences. Its score is the lowest, over its
cuts into two parts with ``l`` and ``r`` occurrences, of ``floor(1000 a n / (l r))``.
A candidate that lies inside a longer one of equal count is dropped, and the best
``top`` of each language are returned.

Method (after ERA, "elastic range" suffix trees):

1. *Prefix counts.* Occurrences of every word, exactly, and of every pair of
   words by hash. Both become bit filters of a fixed size (``filter_bits``): a
   filter may let an infrequent prefix pass, which costs room, and never stops a
   frequent one. A suffix is cut off where its next pair of words is infrequent,
   as no candidate can go on there.
2. *Vertical partitioning.* A group takes word prefixes with about ``group_load``
   occurrences, the memory budget. A word above it is extended to prefixes of two
   words, a pair above it to three. Prefixes are dealt to groups by hash, and which
   are extended is a bit filter too, so nothing here grows with the vocabulary.
3. *Subtrees.* Suffixes of at most ``max_words`` words, equal ones added up in the
   map tasks, go to their group in blocks, one block of a map task for each group.
   There they are sorted, which is the subtree in depth-first order, and a node's
   count is the sum of its leaves'. A node above its group's prefix has leaves in
   several groups, and its parts are added.

In steps 2 and 3 a word is its 64-bit hash (of language and word). Hashes of the
frequent words are checked to differ, and drawn anew with another salt if two
should meet; phrases are put back into words by a join when they are known.

Counts of parts of candidates are joined to them by phrase; sorted input, filters
and joins are written tables, so a lost executor costs one stage. A phrase lies in a
longer candidate of equal count exactly if it lies in one that is a single word
longer, because every phrase between the two has that count as well.

Products are exact: decimals of 38 digits, enough up to 10^13 occurrences.

Edge cases: null and empty texts have no words; repeated rows count each; ties are
broken by the phrase's bytes; an empty table gives an empty result; further columns
are ignored, whatever their names; a text of any length is taken whole.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slugmend.llm.common import map_arrow, slices, texts_of
from slugmend.sources.cuts import materialise

NO_LANGUAGE = "und"
_ENDS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
#: Rows of an Arrow batch that goes back to Spark.
_OUT_ROWS = 1 << 16
#: Bits of one row of a filter, the size of Spark's bitmaps.
_BITMAP = 15


@dataclass(frozen=True)
class PhraseRules:
    max_words: int = 5
    min_count: int = 100
    top: int = 2000
    filter_bits: int = 25  #: 4 MB a filter
    part_bits: int = 10  #: pairs are added up in 2^part_bits parts
    group_load: int = 1 << 20  #: occurrences of a group's prefixes
    buffer_words: int = 1 << 21  #: words whose suffixes a map task adds up at a time


def pieces(text: str) -> Iterator[list[bytes]]:
    """The words of every piece of a text."""
    # bytes.lower() changes A-Z only; what bytes.split() takes besides space and tab ends a piece
    return (piece.split() for piece in text.encode().lower().translate(_ENDS).split(b"\n"))


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[bytes, list[bytes], np.ndarray]]:
    """``(language, vocabulary, ids)`` of about ``size`` words at a time; id 0 stands behind every piece."""

    def fresh() -> tuple[defaultdict, array]:
        ids: defaultdict = defaultdict()
        ids.default_factory = ids.__len__
        ids[b"\n"] = 0
        return ids, array("i")

    blocks: defaultdict = defaultdict(fresh)
    held = 0

    def handed() -> Iterator[tuple[bytes, list[bytes], np.ndarray]]:
        for lang, (ids, found) in blocks.items():
            yield lang.encode(), list(ids), np.frombuffer(found, dtype=np.int32)
        blocks.clear()

    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch), strict=True):
            ids, found = blocks[NO_LANGUAGE if lang is None else lang]
            before = len(found)
            for words in pieces(text):
                if words:
                    found.extend(map(ids.__getitem__, words))
                    found.append(0)
            held += len(found) - before
            if held >= size:
                yield from handed()
                held = 0
    yield from handed()


def _hashes(lang: bytes, words: list[bytes], salt: int) -> np.ndarray:
    """As :func:`_hash_column` has them; never 0."""
    start = b"%d %s " % (salt, lang)
    return np.array([xxhash.xxh64_intdigest(start + w, 42) or 1 for w in words], dtype=np.uint64)


def _hash_column(salt: int) -> Column:
    h = F.xxhash64(F.concat_ws(" ", F.lit(str(salt)), "lang", "word"))
    return F.when(h == 0, F.lit(1).cast("long")).otherwise(h)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in this order."""
    x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (a >> np.uint64(29))
    x = (x + b) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _batches(names: list[str], columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_arrays(columns, names=names).to_batches(_OUT_ROWS)


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _constant(value: bytes, n: int) -> pa.Array:
    return pa.DictionaryArray.from_arrays(np.zeros(n, dtype=np.int32), _strings([value])).cast(pa.string())


def word_counts(texts: DataFrame, rules: PhraseRules) -> DataFrame:
    """``lang``, ``word``, ``f`` of the frequent words; a language's total has a null word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in _blocks(batches, rules.buffer_words):
            counts = np.bincount(ids, minlength=len(words))
            total = int(counts[1:].sum())
            yield from _batches(
                ["lang", "word", "f"],
                [_constant(lang, len(words)), _strings([None, *words[1:]]), pa.array([total, *counts[1:].tolist()], pa.int64())],
            )

    found = texts.transform(map_arrow, run, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f")).filter(
        F.col("word").isNull() | (F.col("f") >= rules.min_count)
    )


class Filter:
    """A set of hashes as bits; tells whether a hash may be in it."""

    def __init__(self, buckets: DataFrame, bits: int):
        """``buckets``: a column ``bucket`` of the set's hashes, their first ``bits`` bits."""
        chunk = min(bits, _BITMAP)
        rows = (
            buckets.groupBy(F.shiftrightunsigned("bucket", chunk).alias("no"))
            .agg(F.bitmap_construct_agg(F.col("bucket").bitwiseAND((1 << chunk) - 1)).alias("bits"))
            .collect()  # at most 2^bits bits
        )
        packed = np.zeros(1 << max(bits - 3, 0), dtype=np.uint8)
        for row in rows:
            part = np.frombuffer(row["bits"], dtype=np.uint8)[: 1 << max(chunk - 3, 0)]
            packed[row["no"] * len(part) :][: len(part)] = part
        self.packed, self.shift = packed, np.uint64(64 - bits)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


@dataclass(frozen=True)
class Partition:
    """What map tasks need of the prefix counts: bit filters of a fixed size."""

    salt: int
    frequent: Filter
    pairs: Filter | None = None
    large: Filter | None = None
    groups: int = 1


def _marked(block: tuple[bytes, list[bytes], np.ndarray], known: Partition) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of the block in text order, 0 for infrequent ones and piece ends,
    and the places where it and the next one are frequent."""
    lang, words, ids = block
    hashes = _hashes(lang, words, known.salt)
    allowed = known.frequent(hashes)
    allowed[0] = False
    marked = np.where(allowed, hashes, np.uint64(0))[ids]
    return marked, np.flatnonzero((marked[:-1] > 0) & (marked[1:] > 0))


def _added(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows of a matrix of words as one, sorted, and their number."""
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    first = _starts(keys, keys.shape[1])
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts[order], first)


def _starts(rows: np.ndarray, depth: int) -> np.ndarray:
    """Where the first ``depth`` columns of sorted rows change."""
    return np.flatnonzero(np.concatenate([[True], (rows[1:, :depth] != rows[:-1, :depth]).any(axis=1)]))


def pair_counts(texts: DataFrame, known: Broadcast, rules: PhraseRules) -> DataFrame:
    """``bucket``, ``f``: occurrences of pairs of words, by the first bits of their hash; frequent ones only.

    A map task sends a part its buckets and counts in one row; a part is an array of counters.
    """
    low = max(rules.filter_bits - rules.part_bits, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, rules.buffer_words):
            marked, at = _marked(block, known.value)
            bucket = (_mix(marked[at], marked[at + 1]) >> np.uint64(64 - rules.filter_bits)).astype(np.uint32)
            bucket, counts = np.unique(bucket, return_counts=True)
            part, bucket, counts = bucket >> np.uint32(low), bucket & np.uint32((1 << low) - 1), counts.astype(np.uint32)
            yield _sent("part", part, lambda at, b=bucket, c=counts: b[at].tobytes() + c[at].tobytes())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sent in _grouped(batches, "part"):
            total = np.zeros(1 << low, dtype=np.int64)
            for block in sent:
                bucket, counts = np.frombuffer(block, dtype=np.uint32).reshape(2, -1)
                total[bucket] += counts  # no bucket stands twice in a block
            found = np.flatnonzero(total >= rules.min_count)
            yield pa.RecordBatch.from_arrays([pa.array(found + (part << low)), pa.array(total[found])], names=["bucket", "f"])

    sent = texts.transform(map_arrow, run, "part long, sent binary")
    return sent.repartition("part").sortWithinPartitions("part").transform(map_arrow, add, "bucket long, f long")


def _sent(name: str, keys: np.ndarray, content: Callable[[slice], bytes]) -> pa.RecordBatch:
    """One row for every run of equal keys, with the content of its places."""
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])) if len(keys) else np.zeros(0, dtype=int)
    sent = [content(slice(start, end)) for start, end in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(keys[edges[:-1]].astype(np.int64)), pa.array(sent, pa.binary())], names=[name, "sent"])


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[bytes]]]:
    """Blocks of every key, from rows sorted by key."""
    rows = (row for b in slices(batches) for row in zip(b.column(key).to_pylist(), b.column("sent").to_pylist(), strict=True))
    for value, found in groupby(rows, key=lambda row: row[0]):
        yield value, (sent for _, sent in found)


def _prefix_length(rows: np.ndarray, large: Filter) -> tuple[np.ndarray, np.ndarray]:
    """The number of words in the group prefix of each suffix, and the prefix's hash."""
    one = rows[:, 0]
    two = _mix(one, rows[:, 1])
    three = _mix(two, rows[:, 2]) if rows.shape[1] > 2 else two
    length = np.where(large(one), np.where(large(two), 3, 2), 1)
    return length, np.choose(length - 1, [one, two, three])


def _suffixes(block: tuple[bytes, list[bytes], np.ndarray], known: Partition, rules: PhraseRules) -> Iterator[pa.RecordBatch]:
    """The block's truncated suffixes with their number, one row for each group."""
    marked, at = _marked(block, known)
    follows = np.zeros(len(marked) + rules.max_words, dtype=bool)
    follows[at] = known.pairs(_mix(marked[at], marked[at + 1]))
    starts = np.flatnonzero(follows)
    if not len(starts):
        return
    padded = np.concatenate([marked, np.zeros(rules.max_words, dtype=np.uint64)])
    rows = np.zeros((len(starts), rules.max_words), dtype=np.uint64)
    rows[:, 0] = padded[starts]
    goes_on = np.ones(len(starts), dtype=bool)
    for k in range(1, rules.max_words):
        goes_on &= follows[starts + k - 1]
        rows[:, k] = np.where(goes_on, padded[starts + k], 0)
    rows, counts = _added(rows)
    group = _prefix_length(rows, known.large)[1] % np.uint64(known.groups)
    order = np.argsort(group, kind="stable")
    rows, counts, group = rows[order], counts[order].astype(np.uint64), group[order]
    yield _sent("grp", group, lambda at: np.concatenate([rows[at].T.ravel(), counts[at]]).tobytes())


def _subtrees(batches: Iterator[pa.RecordBatch], known: Partition, rules: PhraseRules) -> Iterator[pa.RecordBatch]:
    """Counts of the nodes of every group's subtree: ``ids`` (the words' hashes) and ``f``."""
    for _, sent in _grouped(batches, "grp"):
        rows, counts = np.zeros((0, rules.max_words), dtype=np.uint64), np.zeros(0, dtype=np.uint64)
        held: list[np.ndarray] = []
        size = 0
        for block in chain(sent, [None]):
            if block is not None:
                held.append(np.frombuffer(block, dtype=np.uint64).reshape(rules.max_words + 1, -1).T)
                size += len(held[-1])
            if held and (block is None or size >= max(rules.group_load, len(rows))):
                every = np.concatenate([np.column_stack([rows, counts]), *held])
                rows, counts = _added(every[:, :-1], every[:, -1])
                held, size = [], 0
        length = _prefix_length(rows, known.large)[0]
        for depth in range(2, rules.max_words + 1):
            first = _starts(rows, depth)
            f = np.add.reduceat(counts, first)
            # A node above the group's prefix has leaves elsewhere too.
            found = (rows[first, depth - 1] > 0) & ((f >= rules.min_count) | (length[first] > depth))
            ids = rows[first[found], :depth].view(np.int64)
            ends = np.arange(0, ids.size + 1, depth, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.ravel())), pa.array(f[found].astype(np.int64))], names=["ids", "f"]
            )


def _distinct_hashes(words: DataFrame) -> int:
    """The first salt with which all words have hashes of their own."""
    salt = 0
    while not words.groupBy(_hash_column(salt).alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        salt += 1
    return salt


def phrase_counts(texts: DataFrame, rules: PhraseRules) -> tuple[DataFrame, DataFrame]:
    """``(lang, word, f)`` as of :func:`word_counts`, and ``(lang, phrase, m, f)`` of the frequent longer phrases."""
    context = texts.sparkSession.sparkContext
    words = materialise(word_counts(texts, rules), "frequent-words")
    total = words.filter(F.col("word").isNull()).agg(F.sum("f").alias("n")).first()["n"] or 0
    salt = _distinct_hashes(words.filter(F.col("word").isNotNull()))
    hashed = words.filter(F.col("word").isNotNull()).select(_hash_column(salt).alias("h"), "lang", "word", "f")
    of_words = hashed.select(F.shiftrightunsigned("h", 64 - rules.filter_bits).alias("bucket"), "f")
    known = Partition(salt, Filter(of_words, rules.filter_bits))
    pairs = materialise(pair_counts(texts, context.broadcast(known), rules), "frequent-pairs")
    above = Filter(of_words.unionByName(pairs).filter(F.col("f") > rules.group_load), rules.filter_bits)
    known = replace(known, pairs=Filter(pairs, rules.filter_bits), large=above, groups=max(1, -(-total // rules.group_load)))
    sent = context.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, rules.buffer_words):
            yield from _suffixes(block, sent.value, rules)

    nodes = (
        texts.transform(map_arrow, run, "grp long, sent binary").repartition("grp").sortWithinPartitions("grp")
        .transform(map_arrow, lambda batches: _subtrees(batches, sent.value, rules), "ids array<long>, f long")
        .groupBy("ids").agg(F.sum("f").alias("f")).filter(F.col("f") >= rules.min_count)
    )
    nodes = materialise(nodes, "frequent-nodes")
    met = nodes.select("ids", "f", F.posexplode("ids").alias("at", "h")).join(hashed.select("h", "lang", "word"), "h")
    phrases = met.groupBy("ids", "f", "lang").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w")).select(
        "lang", F.array_join("w.word", " ").alias("phrase"), F.size("ids").alias("m"), "f"
    )
    return words, materialise(phrases, "frequent-phrases")


def _first_words(k: Column) -> Column:
    return F.array_join(F.slice("w", F.lit(1), k), " ")


def _last_words(k: Column) -> Column:
    """All words behind the first ``k``."""
    return F.array_join(F.slice("w", k + 1, F.col("m") - k), " ")


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` rows of each language with their rank; a large language is first cut down in salted parts."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = materialise(rows, "scored")
    salts = rows.count() // (50 * top)
    while salts > 0:
        part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase", F.lit(salts)), F.lit(salts + 1))).orderBy(*order)
        rows = materialise(rows.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top).drop("rank"), "best")
        salts //= 25
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= top)


def mine_phrases(docs: DataFrame, rules: PhraseRules = PhraseRules()) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` of each language's best phrases."""
    words, phrases = phrase_counts(docs.select("lang", "text"), rules)
    counts = words.filter(F.col("word").isNotNull()).select("lang", F.col("word").alias("phrase"), "f").unionByName(
        phrases.select("lang", "phrase", "f")
    )
    split = phrases.select("lang", "phrase", "m", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    longer = (
        split.filter(F.col("m") > 2)
        .select("lang", F.explode(F.array(_first_words(F.col("m") - 1), _last_words(F.lit(1)))).alias("phrase"), "a")
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    left = materialise(
        split.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(F.col("longer") < F.col("a"), F.lit(True))).drop("longer"),
        "candidates",
    )
    cuts = left.select(
        "lang", "phrase", "a", "m", "w", F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    ).select("lang", "phrase", "a", "k", _first_words(F.col("k")).alias("head"), _last_words(F.col("k")).alias("tail"))
    part = lambda name, f: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    totals = words.filter(F.col("word").isNull()).select("lang", F.col("f").alias("n"))
    met = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(totals, "lang")
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    product, parts = F.lit(1000).cast("decimal(5,0)") * exact("a") * exact("n"), exact("l") * exact("r")
    scored = met.select("lang", "phrase", "a", "n", "k", "l", "r", product.alias("product"), parts.alias("parts")).select(
        "lang", "phrase", "a", "n", "k", "l", "r", F.expr("product div parts").alias("score")
    )
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
    return _best(lowest, rules.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
