"""Line dedup by a deletion-neighbourhood join, one edit of a word.

DataFrame and SQL functions only.

A line is its words, lower case. Two lines are near-equal if one edit of a word
(one word changed, left out or added) turns one into the other; lines of fewer
than ``edit_words`` words must be equal, and lines of fewer than ``min_words``
are left alone, since such lines meet by chance in unrelated texts. A line goes
if an equal or near-equal line stands at an earlier place; places are ordered
by document id (null last), then line number. Whether that earlier line itself
goes for another one does not matter, so the result has no order of execution.

Method. A line of n words has n variants with one word deleted, and itself.
Variants are hashed keys: two lines are near-equal exactly if

* they have a variant in common that deletes at the same position (a change), or
* one line is a variant of the other (a word left out or added).

Within a key nothing is paired: each line needs the earliest place among the
key's lines only, which is a minimum, however many lines share the key.
The earliest partner found is then verified word by word on the texts.

Cost. Equal lines are counted once, map-side first. Before variants are made,
lines that cannot have a partner are set aside without loss: a single edit
leaves the front half or the back half of a line untouched, so partners share
one of three half-line hashes (halves of n and of n - 1 words, counted from
their end of the line). Only lines that share a half with a different line get
variants; their words are fetched by joining their places to the texts. All
variant hashes of a line come from running XORs of position-bound word hashes,
so a line of n words costs n, not n squared.

Texts move only where they must. Which lines to fetch and which documents to change is
asked of a filter of a fixed size (``_SLOTS`` rows of 64 bits, broadcast, made of hashed
places or ids): what it rules out needs no join and stays where it is. It errs to one
side only, so the joins behind it decide; when it is full, all rows go through them.

Edge cases: null and empty texts have no line with a word; null ids come last;
rows with the same id (repeated rows) share their places and are treated
alike; further columns pass through ``drop_lines`` and are ignored elsewhere;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slugmend.llm.common import WORD_SPACE, temp_name
from slugmend.sources.cuts import made, mark, materialise, release


_SLOTS = 1 << 17


@dataclass(frozen=True)
class LineRules:
    min_words: int = 5  #: shorter lines are left alone
    edit_words: int = 8  #: shorter lines must be equal


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), WORD_SPACE), lambda w: w != "")


def _place(doc_id: str = "doc_id", line_no: str = "line_no") -> Column:
    return F.struct(F.col(doc_id).isNull().alias("last"), F.col(doc_id).alias("doc_id"), F.col(line_no).alias("line_no"))


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``line_no`` (from 0), ``line`` of every line."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def _slot(key: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(key, 6), F.lit(_SLOTS))


def _bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(63).cast("int"))


def _filter(keys: DataFrame, key: Column) -> DataFrame:
    """``slot``, ``bits`` of the hashes ``key``: always ``_SLOTS`` rows."""
    known = keys.groupBy(_slot(key).alias("slot")).agg(F.bit_or(_bit(key)).alias("bits"))
    slots = keys.sparkSession.range(_SLOTS).withColumnRenamed("id", "slot")
    return materialise(slots.join(known, "slot", "left").select("slot", F.coalesce("bits", F.lit(0)).alias("bits")).coalesce(1), "filter")


def _asked(df: DataFrame, key: Column, known: DataFrame, name: str) -> DataFrame:
    """``df`` with a column ``name``: whether the hash ``key`` may be among those of the filter."""
    slot, bits = temp_name(df, "slot"), temp_name(df, "bits")
    known = known.select(F.col("slot").alias(slot), F.col("bits").alias(bits))
    met = df.join(F.broadcast(known), _slot(key) == F.col(slot))
    return met.withColumn(name, F.col(bits).bitwiseAND(_bit(key)) != 0).drop(slot, bits)


def _halves() -> Column:
    """Hashes of the half lines that a partner must share; see the module's text."""
    n = F.size("w")
    front, back = F.floor(n / 2).cast("int"), F.ceil(n / 2).cast("int")
    front1, back1 = F.floor((n - 1) / 2).cast("int"), F.ceil((n - 1) / 2).cast("int")

    def first(k: Column) -> Column:
        return F.xxhash64(F.lit("front"), k, F.slice("w", F.lit(1), k))

    def last(k: Column) -> Column:
        return F.xxhash64(F.lit("back"), k, F.slice("w", n - k + 1, k))

    return F.array_distinct(F.array(first(front), first(front1), last(back), last(back1)))


def _hashed_lines(docs: DataFrame, rules: LineRules) -> DataFrame:
    return (
        lines(docs)
        .select("doc_id", "line_no", F.explode(F.array(_words(F.col("line")))).alias("w"))  # split once; see below
        .withColumn("n", F.size("w"))
        .filter(F.col("n") >= rules.min_words)
        .select(
            "doc_id", "line_no", "n", F.xxhash64("w", F.lit(1)).alias("h"),
            F.when(F.col("n") >= rules.edit_words - 1, _halves()).alias("halves"),
        )
    )


def _suspects(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share a half with a different line."""
    halves = distinct.filter(F.col("halves").isNotNull()).select("h", F.explode("halves").alias("half"))
    shared = materialise(
        halves.groupBy("half").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
        .filter(F.col("lo") != F.col("hi")).select("half"),
        "shared-halves",
    )
    found = materialise(halves.join(shared, "half", "left_semi").select("h").distinct(), "suspects")
    return distinct.join(found, "h", "left_semi").select("h", "n", "first")


def _variants(suspects: DataFrame) -> DataFrame:
    """``h``, ``n``, ``first``, ``at`` (deleted word, null: none), ``key``, ``length`` of every variant of every line.

    The hash of a word sequence is the XOR of its words' hashes, each bound to its
    position. Deleting word i keeps the terms before it and moves those behind it
    one position down.
    """
    terms = suspects.select(
        "h", "n", "first", F.posexplode("w").alias("at", "word")
    ).select(
        "h", "n", "first", "at", F.xxhash64("word", "at").alias("here"), F.xxhash64("word", F.col("at") - 1).alias("down")
    )
    line = Window.partitionBy("h", "n")
    upto = line.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    behind = F.bit_xor("down").over(line).bitwiseXOR(F.bit_xor("down").over(upto))
    before = F.bit_xor("here").over(upto).bitwiseXOR(F.col("here"))
    deleted = terms.select(
        "h", "n", "first", "at", before.bitwiseXOR(behind).alias("key"), (F.col("n") - 1).alias("length")
    )
    whole = terms.groupBy("h", "n", "first").agg(F.bit_xor("here").alias("key")).select(
        "h", "n", "first", F.lit(None).cast("int").alias("at"), "key", F.col("n").alias("length")
    )
    return deleted.unionByName(whole)


def _earlier(variants: DataFrame, rules: LineRules) -> DataFrame:
    """Of each line that has one, an earlier near-equal line: ``h``, ``n``, ``near`` (its place), and where they differ."""
    both_edit = F.col("n") >= rules.edit_words
    variants = variants.filter(both_edit)
    key = Window.partitionBy("key", "length")
    same_place = Window.partitionBy("key", "length", "at")
    deleted, whole = F.col("at").isNotNull(), F.col("at").isNull()
    entry = F.struct("first", "at")
    partner = F.when(
        deleted,
        F.least(  # a changed word; or the line that is left when the word goes
            F.min(F.struct("first", F.col("at"))).over(same_place),
            F.min(F.when(whole, F.struct("first", F.col("at")))).over(key),
        ),
    ).otherwise(F.min(F.when(deleted, entry)).over(key))
    found = variants.select("h", "n", "first", "at", partner.alias("p")).filter(F.col("p.first") < F.col("first"))
    return found.groupBy("h", "n", "first").agg(
        F.min(F.struct(F.col("p.first").alias("near"), F.col("at").alias("own_at"), F.col("p.at").alias("near_at"))).alias("m")
    ).select("h", "n", "first", "m.near", "m.own_at", "m.near_at")


def _without(w: str, at: str) -> Column:
    """The words ``w`` without the one at ``at`` (null: all)."""
    return F.when(F.col(at).isNull(), F.col(w)).otherwise(
        F.concat(F.slice(w, F.lit(1), F.col(at)), F.slice(w, F.col(at) + 2, F.greatest(F.size(w) - F.col(at) - 1, F.lit(0))))
    )


def decide_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per line of at least ``min_words`` words: ``doc_id``, ``line_no``, ``n_words``, ``kept``,
    the earliest equal line (``equal_doc_id``, ``equal_line_no``: itself if it is the first) and an earlier
    near-equal line of that first one, if any (``near_doc_id``, ``near_line_no``)."""
    since = mark()
    hashed = materialise(_hashed_lines(docs, rules), "lines")
    distinct = materialise(
        hashed.groupBy("h", "n").agg(F.min(_place()).alias("first"), F.first("halves").alias("halves"), F.count(F.lit(1)).alias("copies")),
        "distinct-lines",
    )
    suspects = materialise(_suspects(distinct), "suspect-lines")
    # The half-line hashes, most of both tables, have done their work: they go before variants are made.
    wide = made(since)[:-1]
    hashed = materialise(hashed.drop("halves"), "lines")
    distinct = materialise(distinct.drop("halves"), "distinct-lines")
    release(docs.sparkSession, only=wide)
    places = suspects.select("h", "n", "first", F.col("first.doc_id").alias("d"), F.col("first.line_no").alias("l"))
    at_place = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("line_no") == F.col("l"))
    # Rows that repeat an id have several lines at a place: the hash tells the one that is meant.
    known = _filter(places, F.xxhash64("d", "l"))
    asked = _asked(lines(docs), F.xxhash64("doc_id", "line_no"), known, "asked").filter("asked").drop("asked")
    fetched = (
        # Lines are shuffled as they are, in less room than their words. The words come from
        # a generator, behind which the filter stays: they are split once, for joined lines only.
        asked.join(places, at_place)
        .select("h", "n", "first", F.explode(F.array(_words(F.col("line")))).alias("w"))
        .filter((F.size("w") == F.col("n")) & (F.xxhash64("w", F.lit(1)) == F.col("h")))
        .groupBy("h", "n", "first").agg(F.any_value("w").alias("w"))
    )
    fetched = materialise(fetched, "suspect-words")
    found = materialise(_earlier(_variants(fetched), rules), "near-lines")
    own = found.join(fetched.select("h", "n", "w"), ["h", "n"])
    verified = own.join(
        fetched.select(F.col("first").alias("near"), F.col("w").alias("near_w")), "near"
    ).filter(_without("w", "own_at") == _without("near_w", "near_at"))
    verified = materialise(verified.select("h", "n", "near").distinct(), "verified-lines")
    verdict = materialise(
        distinct.select("h", "n", "first", "copies").join(verified, ["h", "n"], "left")
        .filter((F.col("copies") > 1) | F.col("near").isNotNull()).drop("copies"),
        "verdicts",
    )
    # A line that stands once and is near no earlier one is its own first: most lines, which need no join.
    asked = _asked(hashed.select("doc_id", "line_no", "h", "n"), F.col("h"), _filter(verdict, F.col("h")), "asked")
    alone = asked.filter(~F.col("asked")).select(
        "*", F.lit(None).cast(verdict.schema["first"].dataType).alias("first"),
        F.lit(None).cast(verdict.schema["near"].dataType).alias("near"),
    )
    found = asked.filter("asked").join(verdict, ["h", "n"], "left").select(*alone.columns)
    own = F.col("first").isNull()
    return alone.unionByName(found).select(
        "doc_id", "line_no", F.col("n").alias("n_words"),
        (own | ((_place() == F.col("first")) & F.col("near").isNull())).alias("kept"),
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("equal_doc_id"),
        F.when(own, F.col("line_no")).otherwise(F.col("first.line_no")).alias("equal_line_no"),
        F.col("near.doc_id").alias("near_doc_id"), F.col("near.line_no").alias("near_line_no"),
    )


def drop_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents with all columns, their repeated lines taken out of ``text``, ``n_chars`` (if there is one)
    counted anew. A document that loses every line that has a word goes."""
    since = mark()
    gone = materialise(
        decide_lines(docs, rules).filter(~F.col("kept"))
        .groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone")),
        "gone",
    )
    release(docs.sparkSession, only=made(since)[:-1])  # the tables of the decision
    key, lost, left, asked = (temp_name(docs, c) for c in ("gone_doc", "gone", "left", "asked"))
    marked = _asked(docs, F.xxhash64("doc_id"), _filter(gone, F.xxhash64("doc_id")), asked)
    whole = marked.filter(~F.col(asked)).select(*docs.columns)
    marked = marked.filter(asked)
    joined = marked.join(
        gone.select(F.col("doc_id").alias(key), F.col("gone").alias(lost)), F.col("doc_id").eqNullSafe(F.col(key)), "left"
    )
    stays = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains(lost, i))
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    joined = joined.withColumn(left, text).filter(
        F.col(lost).isNull() | F.coalesce(F.trim(F.regexp_replace(left, WORD_SPACE, " ")) != "", F.lit(False))
    )
    return whole.unionByName(joined.select(*(_column(docs, c, left) for c in docs.columns)))


def _column(docs: DataFrame, c: str, text: str) -> Column:
    if c == "text":
        return F.col(text).alias("text")
    if c == "n_chars":
        kind = docs.schema["n_chars"].dataType
        return F.when(F.col("text") == F.col(text), F.col(c)).otherwise(F.length(text).cast(kind)).alias(c)
    return F.col(c)
