"""Quality rules: cross-document line frequency.

Lines are normalised (lower case, white space collapsed, digit runs as ``0``)
and hashed; for each host (the ``source`` column) the distinct documents that
hold a line are counted. A line above the host's limit is boilerplate: it is
removed wherever it stands, and a document that loses most of its words that
way (or fails the base rules) is rejected.

*Distinct documents.* Copies of one document are not evidence of boilerplate:
a document is identified by the hash of its set of lines. Copies (and repeated
rows) then count once, whatever the order, case, spacing and numbers of their
lines, while lines under unrelated texts count once per text, alone or in
blocks of any length. Texts that differ in a line count as two, so near copies
count. A line that is the whole of its documents counts once.

*Limit.* A line is above the limit of its host if it is in more than
``max(min_docs, max_share * documents of the host)`` distinct documents; the host's
documents are counted by the same identity.

Shape of the job: one map over the texts emits 24 bytes per document and per
distinct line of it; a distinct and a count, both combined map-side, give the lines above
the limits. At most ``lines / (max_share * documents)`` lines of a host can be
above, so they fit one array per host. That table is written and joined back
by host: Spark broadcasts it only if the written size is below the session's
threshold, else it shuffles both sides and AQE splits a hot host. A second map
computes the rules. Texts are read twice and never grouped.

Edge cases: null or empty text has no words, fails the base rules and keeps
its row; a null ``source`` is a host of its own; repeated rows get equal
verdicts; an empty table gives an empty result; further columns of the input
pass through ``filter_documents`` unchanged and are ignored by ``line_quality``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slugmend.llm.common import map_arrow, slices, temp_name, texts_of, words
from slugmend.sources.cuts import materialise


@dataclass(frozen=True)
class QualityRules:
    """Limits of the base rules and of the line-frequency rule."""

    min_words: int = 50  #: fewer words fail the base rules
    max_repeat_percent: int = 50  #: more repeated words than this share fail them
    min_docs: int = 20  #: a line in so few distinct documents is never above the limit
    max_share: float = 0.02  #: share of a host's documents beyond which a line is boilerplate
    min_left: float = 0.5  #: a document keeping less than this share of its words is depleted


_DIGITS = re.compile(r"[0-9]+")


def line_hash(line: str) -> int | None:
    """Signed 64-bit hash of the normalised line; None for a line without a word."""
    normal = " ".join(_DIGITS.sub("0", line.lower()).split())
    return xxhash.xxh64_intdigest(normal, 0) - (1 << 63) if normal else None


def _identified_lines(text: str) -> tuple[list[int], int]:
    """The hashes of the distinct lines, and the identity of the document."""
    lines = sorted({h for x in text.split("\n") if (h := line_hash(x)) is not None})
    return lines, xxhash.xxh64_intdigest(np.array(lines, dtype="<i8").tobytes()) - (1 << 63)


def _emit_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        host, line, identity = [], [], []
        for s, text in zip(batch.column("host").to_pylist(), texts_of(batch), strict=True):
            found, own = _identified_lines(text)
            host.extend([s] * (len(found) + 1))
            line.extend([*found, None])  # no line: counts the host's documents
            identity.extend([own] * (len(found) + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(host, pa.string()), pa.array(line, pa.int64()), pa.array(identity, pa.int64())],
            names=["host", "line", "identity"],
        )


def frequent_lines(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """One row per host that has any: ``host``, ``frequent`` (hashes of its lines above the limit)."""
    texts = docs.select(F.col("source").cast("string").alias("host"), "text")
    counts = (
        texts.transform(map_arrow, _emit_lines, "host string, line long, identity long")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > rules.min_docs) | F.col("line").isNull())
    )
    counts = materialise(counts, "line-counts")
    per_line = counts.filter(F.col("line").isNotNull())
    hosts = counts.filter(F.col("line").isNull()).select(F.col("host").alias("of_host"), F.col("n").alias("docs"))
    return (
        per_line.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
        .filter(F.col("n") > F.lit(rules.max_share) * F.col("docs"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("frequent"))
    )


_NO_SYMBOL = bytes(set(range(256)) - set(b"#*$%&|<>"))


def repeated_words(found: list[bytes]) -> int:
    """Words that stand in a three-word window found at least twice."""
    if len(found) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter([ids.setdefault(w, len(ids)) for w in found], dtype=np.int64, count=len(found))
    if len(ids) == len(found):
        return 0
    n = len(ids)
    if n < 1 << 20:
        key = (a[:-2] * n + a[1:-1]) * n + a[2:]
    else:  # the three ids no longer fit one number: number the pairs first
        _, pair = np.unique(a[:-1] * n + a[1:], return_inverse=True)
        key = pair[:-1].astype(np.int64) * n + a[2:]
    _, which, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[which] > 1
    covered = np.zeros(len(found), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def assess(text: str, frequent: frozenset[int], rules: QualityRules) -> tuple[dict, str]:
    """The row of one text, and the text without its frequent lines."""
    found = words(text)
    seen: set[str] = set()
    duplicates = 0
    left_words = len(found)
    lines = text.split("\n")
    left = []
    for line in lines:
        n = 0
        if line and (n := len(words(line))):
            duplicates += line in seen
            seen.add(line)
        if frequent and n and line_hash(line) in frequent:
            left_words -= n
        else:
            left.append(line)
    repeats = repeated_words(found)
    base_failed = len(found) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(found)
    raw = text.encode()
    row = {
        "n_words": len(found),
        "word_chars": len(text) - (len(raw) - sum(map(len, found))),
        "n_symbols": len(raw.translate(None, _NO_SYMBOL)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeats,
        "base_failed": base_failed,
        "kept": not base_failed and left_words >= rules.min_left * len(found),
        "n_left_words": left_words,
        "n_frequent_lines": len(lines) - len(left),
    }
    return row, text if len(left) == len(lines) else "\n".join(left)


_RESULT = pa.schema(
    [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
     ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("n_left_words", pa.int64()),
     ("n_frequent_lines", pa.int64())]
)
_RESULT_DDL = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_left_words long, n_frequent_lines long"
)


def _assessed(batches: Iterator[pa.RecordBatch], rules: QualityRules, text_at: int, frequent_at: int):
    sets: dict[tuple[int, ...], frozenset[int]] = {}
    for batch in slices(batches):
        texts = [t or "" for t in batch.column(text_at).to_pylist()]
        lists = [tuple(x or ()) for x in batch.column(frequent_at).to_pylist()]
        if len(sets) > 1000:
            sets.clear()
        yield batch, [assess(t, sets.setdefault(k, frozenset(k)), rules) for t, k in zip(texts, lists, strict=True)]


def line_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed``, ``kept`` and what was removed."""

    def run(batches):
        for batch, rows in _assessed(batches, rules, 1, 2):
            out = pa.RecordBatch.from_pylist([r for r, _ in rows], schema=_RESULT)
            yield pa.RecordBatch.from_arrays([batch.column(0), *out.columns], names=["doc_id", *out.schema.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _with_frequent(docs.select("doc_id", "text", "source"), "source", rules).select(
        "doc_id", "text", "frequent"
    ).transform(map_arrow, run, f"doc_id {kind}, {_RESULT_DDL}")


def filter_documents(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The kept documents with all their columns: frequent lines taken out of ``text``, ``n_chars`` (if there is one) counted anew."""
    columns = docs.columns
    text_at = columns.index("text")
    frequent = temp_name(docs, "frequent")

    def run(batches):
        for batch, rows in _assessed(batches, rules, text_at, len(columns)):
            keep = pa.array([r["kept"] for r, _ in rows], pa.bool_())
            arrays = [batch.column(i) for i in range(len(columns))]
            texts = [t for _, t in rows]
            arrays[text_at] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                at = columns.index("n_chars")
                arrays[at] = pa.array([len(t) for t in texts], batch.column(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(keep)

    joined = _with_frequent(docs, "source", rules, frequent)
    return joined.select(*columns, frequent).transform(map_arrow, run, docs.schema)


def _with_frequent(docs: DataFrame, host: str, rules: QualityRules, name: str = "frequent") -> DataFrame:
    found = materialise(frequent_lines(docs, rules), "frequent-lines")
    key = temp_name(docs, "of_host")
    return docs.join(
        found.select(F.col("host").alias(key), F.col("frequent").alias(name)),
        docs[host].cast("string").eqNullSafe(F.col(key)),
        "left",
    )
