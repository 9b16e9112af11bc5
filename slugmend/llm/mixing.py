"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Everything here is DataFrame and SQL functions.

*Targets.* Sources in code point order (null last) weigh 5, 2, 1, repeating,
and share the corpus's words; a target stops at three times its source's
words, and the excess is shared again by weight until none is above. That
fixed point is ``min(3 * words, level * weight)`` for one common level, found
by a running sum over the sources in order of ``3 * words / weight``.

*Blocks.* Documents of a source are put in hash order and cut into blocks of
about ``BLOCK_DOCS``; blocks are numbered in that (permuted) order. A source
whose target is ``e`` whole passes and a rest takes every block ``e`` times and
then a run of blocks from the front of the permutation until the rest is
reached; the last block of that run is taken in part, document by document,
to the cut that lands nearest the target. The number of block draws is the
source's exact quota.

*Splitting tree.* The quotas are split among the output shards: at each node
the number of draws that go left is fixed by the shards below it, and how many
of each source go there is a draw of the multivariate hypergeometric law
(source by source: a hypergeometric draw by inverse distribution function,
from a hash of seed, node and source). Quotas stay exact at every node. Each
shard owns a range of every source's draw numbers, so draws are disjoint. Rows
of a shard are shuffled locally, in hash order.

Scale: the tree works on one small row per node (arrays over sources, which
are the named parts of a mixture, not data). Documents are read once to count
words; the running sum over a source's blocks goes in two levels
(``GROUP_BLOCKS`` blocks a group), so a source with a third of all rows is many
small windows. Block rows join documents on (source, block), whose size is
bounded, so no hot key is left in a join.

Edge cases: null text is size 0 and is taken 0 words; a source of size 0 has
target 0; a null source is a source; equal ``doc_id`` (or repeated rows) share
a place in the permutation and are told apart by nothing, so they are taken
alike; an empty table gives an empty result. Reruns agree: every choice is a
hash of seed and identity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slugmend.llm.common import WORD_SPACE, temp_name
from slugmend.sources.cuts import materialise

BLOCK_DOCS = 64
GROUP_BLOCKS = 1024
#: Parts that each shard is written in, so that a shard is not one task.
SHARD_PARTS = 64


@dataclass(frozen=True)
class Mix:
    """Parameters of a mix."""

    weights: tuple[int, ...] = (5, 2, 1)
    max_passes: int = 3
    shards: int = 16
    seed: int = 20240501


def n_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null: 0."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), WORD_SPACE, " ")
    bare = F.trim(trimmed)
    return F.when(bare == "", F.lit(0)).otherwise(
        F.length(bare) - F.length(F.translate(bare, " ", "")) + 1
    ).cast("long")


def source_targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``source``, ``source_size``, ``source_docs``, ``target`` from rows (source, size); one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weights = F.array(*(F.lit(float(w)) for w in mix.weights))
    per = per.withColumn(
        "w", F.element_at(weights, ((F.row_number().over(order) - 1) % len(mix.weights) + 1).cast("int"))
    )
    cap = F.lit(float(mix.max_passes)) * F.col("source_size")
    by_ratio = Window.orderBy(cap / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    # Level if the sources before this one (smaller caps per weight) are held at their caps.
    per = per.withColumn(
        "level",
        (F.sum("source_size").over(everything).cast("double") - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
        / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))),
    ).withColumn("free", F.col("level") * F.col("w") <= cap)
    level = F.min(F.when(F.col("free"), F.struct(cap / F.col("w"), F.col("level")))).over(everything)
    per = per.withColumn("common", level["level"])
    return per.select(
        "source", "source_size", "source_docs",
        F.when(F.col("common") * F.col("w") < cap, F.col("common") * F.col("w")).otherwise(cap).alias("target"),
    )


def _place(mix: Mix) -> Column:
    """Where a document stands in its source's permutation: a 63-bit hash of its id and text."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(mix.seed), F.col("doc_id").cast("string"), F.col("text")), 1)


def _sized(docs: DataFrame, mix: Mix, *more: Column) -> DataFrame:
    return docs.select(
        *more, F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"),
        _place(mix).alias("place"),
    )


def sized_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``doc_id``, ``source``, ``size`` and ``place`` of every row, written once."""
    return materialise(_sized(docs, mix, F.col("doc_id")), "sized")


def _with_block(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Equal parts of the hash range are blocks, so a block's number is its place in the permutation."""
    blocks = F.ceil(F.col("source_docs") / F.lit(BLOCK_DOCS))
    part = F.floor(F.col("place") / F.lit(float(1 << 63)) * blocks)
    joined = sized.join(
        targets.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source"))
    )
    return joined.withColumn("block", F.least(part, blocks - 1)).drop("of_source", "source_docs")


def plan_blocks(keyed: DataFrame) -> DataFrame:
    """One row per block and how it is taken.

    ``rank`` of ``n_ranks`` in the source's permutation, ``whole`` passes over every
    block, ``rest``: words that the part of a pass still wants when it reaches the
    block, ``reached`` if that is any, ``cut`` if the block has more.
    """
    blocks = materialise(
        keyed.groupBy("source", "block").agg(
            F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size")
        ),
        "blocks",
    )
    blocks = blocks.withColumn("group", F.floor(F.col("block") / GROUP_BLOCKS))
    earlier = Window.partitionBy("source").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = blocks.groupBy("source", "group").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("n"))
    groups = groups.select(
        F.col("source").alias("g_source"), F.col("group").alias("g"),
        F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ranks_before"),
        F.sum("n").over(Window.partitionBy("source")).alias("n_ranks"),
    )
    inside = Window.partitionBy("source", "group").orderBy("block")
    words_in_group = F.coalesce(F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = (
        blocks.withColumn("words_in_group", words_in_group)
        .withColumn("rank_in_group", F.row_number().over(inside) - 1)
        .join(groups, F.col("source").eqNullSafe(F.col("g_source")) & (F.col("group") == F.col("g")))
    )
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - whole * F.col("source_size") - F.col("words_before") - F.col("words_in_group")
    return blocks.select(
        "source", "block", (F.col("ranks_before") + F.col("rank_in_group")).alias("rank"), "n_ranks",
        whole.cast("int").alias("whole"), rest.alias("rest"),
        (rest > 0).alias("reached"), ((rest > 0) & (F.col("words") > rest)).alias("cut"),
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(u: Column, good: Column, total: Column, drawn: Column) -> Column:
    """The draw of the hypergeometric law at ``u`` in [0, 1): inverse distribution function from the mode outwards.

    Weights relative to the mode follow from ratios of neighbouring terms. Terms
    beyond 12 standard deviations (and 12) from the mode weigh less than the
    rounding of a double and are not listed.
    """
    long = "bigint"
    least = F.greatest(F.lit(0).cast(long), drawn + good - total)
    most = F.least(good, drawn)
    mode = F.greatest(least, F.least(most, F.floor((drawn + 1.0) * (good + 1.0) / (total + 2.0))))
    reach = F.ceil(F.sqrt(drawn * 1.0 * good / F.greatest(total, F.lit(1))) * 12 + 12)
    none = F.array().cast(f"array<{long}>")

    def ratio(k: Column) -> Column:  # weight of k + 1 over weight of k
        return ((good - k) * 1.0 * (drawn - k)) / ((k + 1) * 1.0 * (total - good - drawn + k + 1))

    def weigh(steps: Column, term) -> Column:
        zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(
            steps, zero,
            lambda s, k: _let(s["w"] * term(k), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum"))),
        )["sum"]

    def walk(steps: Column, state: Column, term, step: int) -> Column:
        return F.aggregate(
            steps, state,
            lambda s, k: F.when(s["found"], s).otherwise(
                _let(
                    s["w"] * term(k),
                    lambda w: F.struct(
                        w.alias("w"), (s["left"] - w).alias("left"), (k + step).cast(long).alias("k"),
                        (s["left"] < w).alias("found"),
                    ),
                )
            ),
        )

    def down_ratio(k: Column) -> Column:
        return 1.0 / ratio(k)

    def from_range(r: Column) -> Column:
        up, down, mid = r["up"], r["down"], r["mode"]

        def from_aim(aim: Column) -> Column:
            start = F.struct(
                F.lit(1.0).alias("w"), (aim - 1.0).alias("left"), mid.alias("k"), (aim < 1.0).alias("found")
            )
            turned = _let(
                walk(up, start, ratio, 1),
                lambda s: F.struct(F.lit(1.0).alias("w"), s["left"].alias("left"), s["k"].alias("k"), s["found"].alias("found")),
            )
            return walk(down, turned, down_ratio, 0)["k"]

        return _let(u * (1.0 + weigh(up, ratio) + weigh(down, down_ratio)), from_aim)

    def ranged(m: Column) -> Column:
        lo, hi = F.greatest(least, m["mode"] - m["reach"]), F.least(most, m["mode"] + m["reach"])
        return F.struct(
            m["mode"].alias("mode"),
            F.when(m["mode"] < hi, F.sequence(m["mode"], hi - 1)).otherwise(none).alias("up"),
            F.when(lo < m["mode"], F.sequence(m["mode"] - 1, lo, F.lit(-1).cast(long))).otherwise(none).alias("down"),
        )

    return _let(_let(F.struct(mode.cast(long).alias("mode"), reach.cast(long).alias("reach")), ranged), from_range)


def _left_quotas(mix: Mix, level: int) -> Column:
    """Of a node's quotas, in source order, how many draws of each source go left."""
    start = F.struct(F.col("n_left").alias("drawn"), F.col("n").alias("total"), F.array().cast("array<bigint>").alias("out"))

    def draw(s: Column, q: Column) -> Column:
        bits = F.xxhash64(F.lit(mix.seed), F.lit(level), F.col("shard"), F.size(s["out"]))
        u = F.shiftrightunsigned(bits, 11) / F.lit(float(1 << 53))
        return _let(
            hypergeometric(u, q, s["total"], s["drawn"]),
            lambda k: F.struct(
                (s["drawn"] - k).alias("drawn"), (s["total"] - q).alias("total"),
                F.concat(s["out"], F.array(k)).alias("out"),
            ),
        )

    return F.when(F.col("below") > 1, F.aggregate("quota", start, draw)["out"]).otherwise(F.col("quota"))


def split_quotas(quotas: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per source: ``source``, ``lasts`` (for each shard in turn, the number after its last draw).

    ``quotas``: source, quota (block draws). Nodes of the tree are rows (first shard,
    shards below, quotas in source order); each level splits every node that has
    more than one shard. Shard ``i`` owns draws ``lasts[i - 1] .. lasts[i] - 1``.
    """
    entry = F.struct(F.col("source").isNull().alias("none"), "source", F.col("quota").cast("bigint").alias("quota"))
    nodes = quotas.agg(F.sort_array(F.collect_list(entry)).alias("s")).select(
        F.transform("s", lambda x: x["source"]).alias("sources"), F.transform("s", lambda x: x["quota"]).alias("quota"),
        F.lit(0).alias("shard"), F.lit(mix.shards).alias("below"),
    )
    for level in range((mix.shards - 1).bit_length()):
        half = F.floor((F.col("below") + 1) / 2).cast("int")
        nodes = (
            nodes.withColumn("n", F.aggregate("quota", F.lit(0).cast("bigint"), lambda a, q: a + q))
            .withColumn("half", half)
            .withColumn("n_left", F.floor(F.col("n") * F.col("half") / F.col("below")))
            .withColumn("left", _left_quotas(mix, level))
        )
        nodes = materialise(nodes, "tree")
        left = F.struct("shard", F.col("half").alias("below"), F.col("left").alias("quota"))
        right = F.struct(
            (F.col("shard") + F.col("half")).alias("shard"), (F.col("below") - F.col("half")).alias("below"),
            F.zip_with("quota", "left", lambda q, k: q - k).alias("quota"),
        )
        whole = F.struct("shard", "below", "quota")
        nodes = nodes.select(
            "sources", F.explode(F.when(F.col("below") > 1, F.array(left, right)).otherwise(F.array(whole))).alias("c")
        ).select("sources", "c.quota", "c.shard", "c.below")
    flat = nodes.select("shard", F.explode(F.arrays_zip("sources", "quota")).alias("z"))
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    return (
        flat.select("shard", F.col("z.sources").alias("source"), F.col("z.quota").alias("quota"))
        .select("source", F.struct("shard", upto.alias("last")).alias("last"))
        .groupBy("source")
        .agg(F.transform(F.sort_array(F.collect_list("last")), lambda x: x["last"]).alias("lasts"))
    )


def _limits(keyed: DataFrame, blocks: DataFrame) -> DataFrame:
    """For each block taken in part (one of a source at most), the place before which its documents are taken.

    Documents are taken in order of place, to the cut that lands nearest the rest.
    """
    cut = blocks.filter("cut").select(F.col("source").alias("c_source"), F.col("block").alias("c"), "rest")
    order = Window.partitionBy("source", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.select("source", "block", "place", "size")
        .join(cut, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("block") == F.col("c")))
        .withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
        .filter(F.col("before") + F.col("size") / 2 >= F.col("rest"))
        .groupBy(F.col("source").alias("c_source"), F.col("block").alias("c"))
        .agg(F.min("place").alias("limit"))
    )


def mix_plan(sized: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """Targets of the sources; and one row per block with ``whole``, ``limit`` and the ``shards`` of its passes."""
    targets = materialise(source_targets(sized, mix), "targets")
    keyed = _with_block(sized, targets)
    blocks = materialise(plan_blocks(keyed), "block-plan")
    limits = materialise(_limits(keyed, blocks), "limits")
    passes = F.col("whole") + F.col("reached").cast("int")
    owned = split_quotas(blocks.groupBy("source").agg(F.sum(passes).alias("quota")), mix)
    owned = materialise(owned.withColumnRenamed("source", "of_source"), "owned")

    def shard_of(draw: Column) -> Column:
        return F.size(F.filter("lasts", lambda last: last <= draw))

    shards = F.when(
        passes > 0,
        F.transform(F.sequence(F.lit(0), passes - 1), lambda p: shard_of(p * F.col("n_ranks") + F.col("rank"))),
    ).otherwise(F.array().cast("array<int>"))
    plan = (
        blocks.join(owned, F.col("source").eqNullSafe(F.col("of_source")))
        .join(limits, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("block") == F.col("c")), "left")
        .select(
            F.col("source").alias("b_source"), F.col("block").alias("b"), "whole", "limit", shards.alias("shards")
        )
    )
    return targets, materialise(plan, "shards")


def place_rows(rows: DataFrame, targets: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, size, place and more) with ``shards``: the shard of every copy that the mix takes."""
    joined = _with_block(rows, targets).join(
        plan, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b"))
    )
    beyond = F.coalesce(F.col("place") >= F.col("limit"), F.lit(False))
    return joined.withColumn("shards", F.when(beyond, F.slice("shards", F.lit(1), F.col("whole"))).otherwise(F.col("shards")))


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """One row per document: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` and ``shards`` (of its copies)."""
    sized = sized_documents(docs, mix)
    return place_rows(sized, *mix_plan(sized, mix)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"), "shards"
    )


def mix_rows(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: a row of ``docs`` for every copy taken, all columns.

    Rows of a shard lie together, in hash order, within each of its parts.
    """
    plan = mix_plan(sized_documents(docs, mix), mix)
    rows = _sized(docs, mix, F.struct(*docs.columns).alias("row"))
    copies = place_rows(rows, *plan).select("row", "place", F.posexplode("shards").alias("copy", "shard"))
    key = F.xxhash64(F.lit(mix.seed), F.lit("shuffle"), "shard", "place", "copy")
    return (
        copies.withColumn("key", key)
        .repartition("shard", F.pmod("key", F.lit(SHARD_PARTS)))
        .sortWithinPartitions("shard", "key")
        .select("row.*")
    )
