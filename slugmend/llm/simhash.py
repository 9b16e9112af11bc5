"""SimHash near-dedup by pigeonhole blocks.

Fingerprint: 64 bits; a bit is set if over half of the XXH64 values (seed 42)
of the text's word shingles have it, repeats included. Texts without a word
have fingerprint zero, which links like any other.

Linking: the 64 bits are cut into 7 blocks. Two fingerprints that differ in at
most 4 bits agree on at least 3 blocks, so they share one of the 35 keys made
of 3 blocks (about 27 bits each). Equal fingerprints are one class from the
start, so a group of exact copies, however large, is one row here. Within one
key no pairs are listed. Instead, in three steps that are exact together:

1. every fingerprint is compared with the smallest, the largest and two
   hash-chosen members of its key: linear in the key's rows;
2. connected components of those links (``graph.components``);
3. keys that still hold members of different components are compared
   across components only, and only against the members outside the key's
   largest component. A dense group of near copies is one component by then,
   so this step sees chance meetings, not the group.

A link lost by skipping pairs inside one component cannot change the
components, which are the result. Skew: keys are counted before the join and
the joins are on written tables, so AQE can split a large key.

Edge cases: null text is an empty text; repeated rows and equal texts share a
component; a null ``doc_id`` is never a component's id unless its whole
component has none (then the id is null); an empty table gives an empty
result; further columns are ignored (``link_documents``) or passed through
(``one_per_component``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slugmend.llm.common import map_arrow, slices, temp_name, texts_of, words
from slugmend.llm.graph import components, merged
from slugmend.sources.cuts import made, mark, materialise, release

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Blocks to cut 64 bits into, beyond the bits that may differ: so many blocks always agree.
AGREEING_BLOCKS = 3


def fingerprint(text: str, shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, unsigned."""
    found = [w.lower() for w in words(text)]  # bytes.lower() changes A-Z only
    if not found:
        return 0
    if len(found) < shingle:
        grams = [b" ".join(found)]
    else:
        grams = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    values = np.array([digest(g, 42) for g in grams], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(values), 1 << 16):
        part = values[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(values), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        values = np.array([fingerprint(t, shingle) for t in texts_of(batch, "text")], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in keep), pa.array(values.view(np.int64))], names=[*keep, "fp"]
        )


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64 bits as a signed long) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").transform(
        map_arrow, lambda batches: _fingerprints(batches, shingle, ["doc_id"]), f"doc_id {kind}, fp long"
    )


def _masks(max_bits: int) -> list[int]:
    """Signed 64-bit masks of every choice of blocks that must agree."""
    blocks = max_bits + AGREEING_BLOCKS
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(one[i] for i in chosen) for chosen in combinations(range(blocks), AGREEING_BLOCKS)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _close(a: Column, b: Column, max_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= max_bits


def link_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(node, root)`` over distinct fingerprints ``fp``: nodes with a link, and their component's smallest member."""
    masks = F.array(*(F.lit(m).cast("long") for m in _masks(max_bits)))
    keyed = distinct.select("fp", F.posexplode(masks).alias("mask_no", "mask")).select(
        "fp", F.xxhash64("mask_no", F.col("fp").bitwiseAND(F.col("mask"))).alias("key")
    )
    members = ["lo", "hi", "near", "far"]
    pick = F.xxhash64(F.col("fp"), F.lit(7))
    shared = materialise(
        keyed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"),
            F.min_by("fp", pick).alias("near"), F.max_by("fp", pick).alias("far"),
        )
        .filter(F.col("n") > 1),
        "shared-keys",
    )
    met = materialise(keyed.join(shared.drop("n"), "key").select("key", "fp", *members), "met")
    stars = (
        met.select("fp", F.explode(F.array(*members)).alias("to"))
        .filter((F.col("fp") != F.col("to")) & _close(F.col("fp"), F.col("to"), max_bits))
        .distinct()
    )
    first = materialise(components(stars, "fp", "to"), "first-components")
    # Label by component; keys with one component only need no more work.
    labelled = met.select("key", "fp").join(first, F.col("fp") == F.col("node"), "left").select(
        "key", "fp", F.coalesce("root", "fp").alias("c")
    )
    sizes = labelled.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size"))
    mixed = materialise(
        sizes.groupBy("key")
        .agg(F.count(F.lit(1)).alias("parts"), F.max_by("c", F.struct("size", "c")).alias("largest"))
        .filter(F.col("parts") > 1)
        .select("key", "largest"),
        "mixed-keys",
    )
    rest = materialise(labelled.join(mixed, "key"), "mixed")
    one = rest.filter(F.col("c") != F.col("largest")).select("key", F.col("fp").alias("a"), F.col("c").alias("ca"))
    two = rest.select("key", F.col("fp").alias("b"), F.col("c").alias("cb"))
    across = (
        one.join(two, "key")
        .filter((F.col("ca") != F.col("cb")) & _close(F.col("a"), F.col("b"), max_bits))
        .select("ca", "cb")
        .distinct()
    )
    second = materialise(components(across, "ca", "cb"), "second-components")
    return merged(first, second)


def _classes(prints: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``root``, ``component_id`` of every distinct fingerprint of ``prints`` (fp, doc_id)."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "distinct-fingerprints")
    links = link_fingerprints(distinct.select("fp"), max_bits)
    rooted = materialise(
        distinct.join(links, F.col("fp") == F.col("node"), "left").select(
            "fp", "low_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    ids = materialise(rooted.groupBy("root").agg(F.min("low_id").alias("component_id")), "component-ids")
    return materialise(rooted.join(ids, "root").select("fp", "root", "component_id"), "classes")


def link_documents(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest doc_id)."""
    prints = materialise(fingerprints(docs, shingle), "fingerprints")
    return prints.join(_classes(prints, max_bits), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_component(docs: DataFrame, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of every component, that of its smallest doc_id (null last), with all columns of ``docs``.

    Rows are written once with their fingerprint and a row number, so that one of
    several rows with that doc_id is told from the others.
    """
    columns = docs.columns
    fp, row_no = temp_name(docs, "fp"), temp_name(docs, "row_no")
    text_at = columns.index("text")

    def run(batches):
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], names=[*columns, fp])

    schema = T.StructType([*docs.schema.fields, T.StructField(fp, T.LongType())])
    rows = materialise(docs.transform(map_arrow, run, schema).withColumn(row_no, F.monotonically_increasing_id()), "printed")
    since = mark()
    prints = rows.select(F.col(fp).alias("fp"), F.col("doc_id"), F.col(row_no).alias("row_no"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_no"))
    rooted = materialise(prints.join(_classes(prints, max_bits).select("fp", "root"), "fp"), "rooted-rows")
    # The rows that go are told, as they are fewer than those that stay: most components have one row.
    several = materialise(
        rooted.groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("root", F.col("first.row_no").alias("stays")),
        "several",
    )
    gone = materialise(
        rooted.join(several, "root").filter(F.col("row_no") != F.col("stays")).select(F.col("row_no").alias(row_no)), "gone"
    )
    release(docs.sparkSession, only=made(since)[:-1])  # all but the rows that go
    return rows.join(gone, row_no, "left_anti").select(*columns)
