"""MinHash near-dedup by an LSH forest.

A document's set is its distinct shingles of ``shingle`` words (A-Z lower-cased; the
whole sequence if it has fewer words). Documents are linked if their sets have a
Jaccard similarity of ``percent`` or more, and a component is what links reach.

Method. Equal sets are one class from the start, so copies, however many, are one
row. Every class has a signature of ``trees`` times ``depth`` minimum hashes. Each tree
is a sorted order of the signatures: range-partitioned and sorted, so a region (the
classes that share a prefix) may be cut by a partition's end, which costs its pairs
one of the trees. Scans of the orders emit candidates:

1. *Neighbours.* Each class with its predecessors of the same region, the longest
   common prefix first. Candidates are verified in two rounds: every class's best
   one, then the others that still lie between components.
2. *Regions.* A region reaches as far up as it has at most ``region`` classes, from
   the prefix of two hashes on: sparse neighbourhoods are compared at a small depth,
   crowded ones deeper. In it classes of different components are compared.
3. *Crowded regions* with more than ``region`` classes at full depth and more than one
   component are not cut off: their classes are joined exactly, on the rarest
   shingles of each set. Of two similar sets of n <= m shingles the first common one,
   rarest first, stands in the first ninth of the smaller set and the first fifth of
   the larger one, and enough shingles are left behind it in both for the limit (prefix
   and position filter). Within a shingle's sets nothing is paired inside a component,
   nor inside the component that most of them belong to.

A link inside a component cannot change it and is not looked for, so a group of near
copies costs its neighbours, not its pairs. Candidates are first held against each
other by two bits of every minimum hash (a pair at the limit fails that by chance in
one of 10^7 cases) and then always confirmed on the full sets. Two classes at the
limit of 0.8 share a prefix of two in one of 24 trees but for one case in 10^10, one of
five but for one in 10^4, and in that case (a crowded region) step 3 is exact.

Sets are made again from the texts of the classes that are candidates, found by a bit
filter of a fixed size; no text is shuffled.

Edge cases: null and empty texts have an empty set and are linked with nothing; a null
``doc_id`` is a component's id only if it has no other; repeated rows are copies; an
empty table gives an empty result; further columns are ignored; texts are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slugmend.llm.collocations import Filter
from slugmend.llm.common import map_arrow, slices, texts_of, words
from slugmend.llm.graph import components, merged
from slugmend.sources.cuts import materialise

_SKETCH = 4  # longs of two-bit minimum hashes
_CHUNK = 1 << 18  # rows of a sorted order that a scan holds


@dataclass(frozen=True)
class ForestRules:
    shingle: int = 4
    percent: int = 80
    trees: int = 24
    depth: int = 5
    top: int = 2  #: hashes of the shortest prefix
    region: int = 32
    differing: int = 39  #: two-bit hashes of 120 that may differ
    filter_bits: int = 25


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    found = [w.lower() for w in words(text)]  # bytes.lower() changes A-Z only
    if len(found) < size:
        grams = {b" ".join(found)} if found else set()
    else:
        grams = set(map(b" ".join, zip(*(found[i:] for i in range(size)), strict=False)))
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, grams), dtype=np.uint64, count=len(grams)))


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rnd = np.random.default_rng(20)
    return rnd.integers(0, 1 << 64, n, dtype=np.uint64), rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], n: int) -> np.ndarray:
    """``n`` minimum hashes of every set; sets are not empty."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), n), dtype=np.uint32)
    for k, (x, m) in enumerate(zip(*_permutations(n), strict=True)):
        out[:, k] = np.minimum.reduceat(((every ^ x) * m) >> np.uint64(32), starts)
    return out


def _text_key(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode(), 42)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def prints(docs: DataFrame, rules: ForestRules) -> DataFrame:
    """``doc_id``, ``n``, ``c`` (of equal sets, null without words), ``t`` (of the text) and ``sig`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch)
            sets = [shingles(t, rules.shingle) for t in texts]
            full = [s for s in sets if len(s)]
            sig = iter(signatures(full, rules.trees * rules.depth)) if full else iter(())
            columns = {
                "doc_id": batch.column("doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "c": pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                "t": _signed([_text_key(t) for t in texts]),
                "sig": pa.array([next(sig).tobytes() if len(s) else None for s in sets], pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.select("doc_id", "text").transform(map_arrow, run, f"doc_id {kind}, n long, c binary, t long, sig binary")


def _prefix_names(rules: ForestRules) -> list[str]:
    return [f"h{d}" for d in range(rules.top, rules.depth + 1)]


def forest(classes: DataFrame, rules: ForestRules) -> DataFrame:
    """Of every class and tree a row: hashes of the prefixes from ``top`` values on, ``node``, the two-bit hashes
    and, if the classes have one, ``root``."""
    prefixes = _prefix_names(rules)
    labels = [c for c in classes.columns if c == "root"]
    sketch = [f"s{i}" for i in range(_SKETCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            sig = np.stack([np.frombuffer(s, dtype=np.uint32) for s in batch.column("sig").to_pylist()])
            node = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), rules.trees)
            two = np.zeros((len(sig), _SKETCH * 32), dtype=np.uint8)
            two[:, : sig.shape[1]] = sig & 3
            bits = np.stack([two & 1, two >> 1], axis=2).reshape(len(sig), -1)
            longs = np.repeat(np.packbits(bits, axis=1, bitorder="little").view(np.int64), rules.trees, axis=0)
            trees = sig.reshape(-1, rules.depth).astype(np.uint64)
            h = np.tile(np.arange(rules.trees, dtype=np.uint64), len(sig)) + np.uint64(1)
            columns = []
            for d in range(rules.depth):
                h = (h ^ trees[:, d]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(31)
                if d + 1 >= rules.top:
                    columns.append(pa.array(h.view(np.int64)))
            columns += [pa.array(node), *(pa.array(longs[:, i]) for i in range(_SKETCH))]
            columns += [pa.array(np.repeat(batch.column(c).to_numpy(zero_copy_only=False), rules.trees)) for c in labels]
            yield pa.RecordBatch.from_arrays(columns, names=[*prefixes, "node", *sketch, *labels])

    schema = ", ".join(f"{c} long" for c in [*prefixes, "node", *sketch, *labels])
    return classes.select("node", "sig", *labels).transform(map_arrow, run, schema)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows of a sorted partition as matrices of longs, ``_CHUNK`` at a time."""
    held: list[np.ndarray] = []
    for batch in slices(batches, _CHUNK):
        held.append(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
        if sum(map(len, held)) >= _CHUNK:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the two-bit hashes differ."""
    x = (a ^ b).view(np.uint64)
    return np.bitwise_count((x | x >> np.uint64(1)) & np.uint64(0x5555555555555555)).sum(axis=1, dtype=np.int64)


def _sorted(rows: DataFrame, rules: ForestRules) -> DataFrame:
    order = [*_prefix_names(rules), "node"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _pair_batch(a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> pa.RecordBatch:
    columns = [np.minimum(a, b), np.maximum(a, b), apart]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["a", "b", "apart"])


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.min("apart").alias("apart"))


def neighbours(rows: DataFrame, rules: ForestRules) -> DataFrame:
    """``a``, ``b``, ``apart``: neighbours in any of the orders that may be similar."""
    at = rules.depth - rules.top + 1  # of the node; two-bit hashes behind it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in _chunks(batches):
            for back in (1, 2):  # the first of two may be a stranger
                one, two = m[:-back], m[back:]
                met = np.flatnonzero((one[:, 0] == two[:, 0]) & (one[:, at] != two[:, at]))
                apart = _distance(one[met, at + 1 :], two[met, at + 1 :])
                near = met[apart <= rules.differing]
                yield _pair_batch(one[near, at], two[near, at], apart[apart <= rules.differing])

    return _distinct_pairs(_sorted(rows, rules).transform(map_arrow, run, "a long, b long, apart long"))


def across_regions(rows: DataFrame, rules: ForestRules) -> DataFrame:
    """Candidates of different components (``root``, the last column of ``rows``) in the same region,
    with a null ``b`` for a class in a crowded region of several components."""
    at = rules.depth - rules.top + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m in _chunks(batches):
            node, root, sketch = m[:, at], m[:, -1], m[:, at + 1 : -1]
            region = np.full(len(m), -1)
            for d in range(at):  # the shortest prefix with few classes
                ends = np.flatnonzero(np.concatenate([[True], m[1:, d] != m[:-1, d], [True]]))
                number = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
                few = (np.diff(ends) <= rules.region)[number] & (region < 0)
                region[few] = (number * rules.depth + d)[few]
            for back in range(1, min(rules.region, len(m))):
                met = np.flatnonzero((region[:-back] == region[back:]) & (region[back:] >= 0) & (root[:-back] != root[back:]))
                apart = _distance(sketch[met], sketch[met + back])
                near = met[apart <= rules.differing]
                if len(near):
                    yield _pair_batch(node[near], node[near + back], apart[apart <= rules.differing])
            # Crowded at full depth: number is that of the full prefixes.
            crowded = np.flatnonzero(region < 0)
            if len(crowded):
                low, high = (f.reduceat(root, ends[:-1]) for f in (np.minimum, np.maximum))
                mixed = node[crowded[(low != high)[number[crowded]]]]
                columns = [pa.array(mixed), pa.nulls(len(mixed), pa.int64()), pa.nulls(len(mixed), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "apart"])

    return _distinct_pairs(_sorted(rows, rules).transform(map_arrow, run, "a long, b long, apart long"))


def fetch_sets(docs: DataFrame, nodes: DataFrame, rules: ForestRules) -> DataFrame:
    """``node``, ``s`` (its sorted hashes) of the given classes (``node``, ``t``, ``c``), made from their texts."""
    wanted = nodes.select(F.shiftrightunsigned("t", 64 - rules.filter_bits).alias("bucket"))
    known = docs.sparkSession.sparkContext.broadcast(Filter(wanted, rules.filter_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch)
            keys = np.array([_text_key(t) for t in texts], dtype=np.uint64)
            # Copies of one text are next to each other often enough to be worth a look.
            found = {int(keys[i]): shingles(texts[i], rules.shingle) for i in np.flatnonzero(known.value(keys))}
            columns = [
                _signed(list(found)),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in found.values()], pa.binary()),
                pa.array([s.tobytes() for s in found.values()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["t", "c", "s"])

    sets = docs.select("text").transform(map_arrow, run, "t long, c binary, s binary")
    met = sets.join(nodes, ["t", "c"]).select("node", "s")
    return materialise(met.groupBy("node").agg(F.any_value("s").alias("s")), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, rules: ForestRules) -> DataFrame:
    """The pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            good = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                good.append(100 * both >= rules.percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("s").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("s").alias("y"))
    met = pairs.select("a", "b").join(one, "a").join(two, "b")
    return materialise(met.transform(map_arrow, run, "a long, b long"), "links")


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` with the components ``ra`` and ``rb`` of their ends, those of one component left out."""
    for end in ("a", "b"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias("r"))
        pairs = pairs.join(of, end, "left").withColumn(f"r{end}", F.coalesce("r", end)).drop("r")
    return pairs.filter(F.col("ra") != F.col("rb"))


def _best(pairs: DataFrame) -> DataFrame:
    """The best pair of every component."""
    ends = pairs.select("a", "b", "apart", F.explode(F.array("ra", "rb")).alias("of"))
    return ends.groupBy("of").agg(F.min(F.struct("apart", "a", "b")).alias("p")).select("p.a", "p.b").distinct()


def _rarest(sets: DataFrame, roots: DataFrame, rules: ForestRules) -> DataFrame:
    """Pairs ``a``, ``b`` of sets of different components that share one of their rarest shingles, as all similar sets do.

    ``at`` is a shingle's place in its set, rarest first. Similar sets share ``percent`` shares of
    100 + ``percent`` of both sizes at least, and not more than stands in either from the first common one on."""
    p = rules.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for node, s in zip(batch.column("node").to_pylist(), batch.column("s").to_pylist(), strict=True):
                h = np.frombuffer(s, dtype=np.int64)
                columns = [pa.array(np.full(len(h), node)), pa.array(np.full(len(h), len(h))), pa.array(h)]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "h"])

    every = materialise(sets.transform(map_arrow, run, "node long, n long, h long"), "crowded-shingles")
    often = materialise(every.groupBy("h").agg(F.count(F.lit(1)).alias("f")).filter("f > 1"), "crowded-counts")
    # A shingle of one set only is the rarest there is, and pairs nobody: it counts, but needs no row.
    shared = every.join(often, "h")
    own = shared.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("l"))
    own = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = own.select("node", "n", "root", F.size("l").alias("some"), F.posexplode("l").alias("no", "k"))
    placed = placed.select("node", "n", "root", (F.col("n") - F.col("some") + F.col("no")).alias("at"), "k.h")
    left = F.col("n") - F.col("at")
    keys = materialise(placed.filter(100 * left >= p * F.col("n")), "crowded-keys")
    parts = keys.groupBy("h", "root").agg(F.count(F.lit(1)).alias("size")).groupBy("h")
    mixed = materialise(
        parts.agg(F.count(F.lit(1)).alias("parts"), F.max_by("root", F.struct("size", "root")).alias("most"))
        .filter("parts > 1").select("h", "most"),
        "mixed-keys",
    )
    met = materialise(keys.join(mixed, "h").withColumn("out", F.col("root") != F.col("most")).drop("most"), "mixed")
    # The smaller set of two (by size, then node) is a; its first common shingle stands further ahead.
    one = met.filter((100 + p) * left >= 2 * p * F.col("n")).select(
        "h", "out", F.col("node").alias("a"), F.col("n").alias("na"), F.col("root").alias("ra"), left.alias("la")
    )
    two = met.select("h", "out", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("root").alias("rb"), left.alias("lb"))
    similar = (
        (F.col("ra") != F.col("rb")) & (F.struct("na", "a") < F.struct("nb", "b")) & (100 * F.col("na") >= p * F.col("nb"))
        & ((100 + p) * F.least("la", "lb") >= p * (F.col("na") + F.col("nb")))
    )

    def pairs(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.drop("out").join(y.drop("out"), "h").filter(similar).select("a", "b")

    return pairs(one.filter("out"), two).unionByName(pairs(one.filter(~F.col("out")), two.filter("out"))).distinct()


def _joined(now: DataFrame, links: DataFrame) -> DataFrame:
    """The components with further links, looked for among their roots only."""
    over = materialise(components(_between(links, now), "ra", "rb"), "further-components")
    return materialise(merged(now, over), "components")


def link_classes(docs: DataFrame, classes: DataFrame, rules: ForestRules) -> DataFrame:
    """``node``, ``root`` of every class (``node``, ``t``, ``c``, ``sig``) that has a link."""
    where = classes.select("node", "t", "c")

    def sets_of(nodes: DataFrame) -> DataFrame:
        return fetch_sets(docs, materialise(where.join(nodes, "node", "left_semi"), "wanted"), rules)

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node"))

    pairs = materialise(neighbours(forest(classes, rules), rules), "neighbours")
    sets = sets_of(ends(pairs))
    best = materialise(_best(pairs.withColumns({"ra": F.col("a"), "rb": F.col("b")})), "best")
    now = materialise(components(confirm(best, sets, rules), "a", "b"), "components")
    left = materialise(_between(pairs.join(best, ["a", "b"], "left_anti"), now), "candidates")
    now = _joined(now, confirm(left, sets, rules))
    # Regions: only classes of different components are compared. Classes are labelled, not their rows in every tree.
    labelled = classes.select("node", "sig").join(now, "node", "left").withColumn("root", F.coalesce("root", "node"))
    found = materialise(across_regions(forest(labelled, rules), rules), "regions")
    met = materialise(
        found.filter(F.col("b").isNotNull()).select("a", "b").join(pairs.select("a", "b"), ["a", "b"], "left_anti"), "met"
    )
    crowded = found.filter(F.col("b").isNull()).select(F.col("a").alias("node"))
    more = sets_of(ends(met).unionByName(crowded))
    now = _joined(now, confirm(met, more, rules))
    if crowded.isEmpty():
        return now
    rare = _rarest(more.join(crowded.distinct(), "node", "left_semi"), now, rules)
    return _joined(now, confirm(rare, more, rules))


def near_duplicates(docs: DataFrame, rules: ForestRules = ForestRules()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id reachable), ``kept`` of every row."""
    docs = docs.select("doc_id", "text")
    printed = materialise(prints(docs, rules), "prints")
    classes = (
        printed.filter(F.col("c").isNotNull()).groupBy("c")
        .agg(F.min("doc_id").alias("low"), F.min_by("sig", "t").alias("sig"), F.min("t").alias("t"))
    )
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    linked = link_classes(docs, classes, rules)
    rooted = materialise(
        classes.select("c", "low", "node").join(linked, "node", "left").select("c", "low", F.coalesce("root", "node").alias("root")),
        "rooted",
    )
    ids = materialise(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    known = materialise(rooted.join(ids, "root").select("c", "component_id"), "known")
    component = F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return printed.select("doc_id", "n", "c").join(known, "c", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
