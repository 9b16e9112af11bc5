"""Slug and text expressions."""

from __future__ import annotations

import datetime as dt
import random

from model import normalize
from pyspark.sql import functions as F

from slugmend.functions import slug, text

_ALPHABET = "aAbBzZ09 _-!#.,éÉçÇãõüßøæİıñŅ̃́—'\"/\\ \t\n" + "中文ΑΒγ"


def _random_texts(n=400, seed=5):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(_ALPHABET) for _ in range(rnd.randint(0, 30))),) for _ in range(n)]


def test_normalise_matches_reference_rule_and_is_idempotent(spark):
    rows = _random_texts() + [(None,), ("",), ("***",), ("  Ação__Brand#2!",), ("SMALL RING Brand#2",)]
    df = spark.createDataFrame(rows, "t string").select(
        "t", slug.normalize_slug("t").alias("n"), slug.normalize_slug(slug.normalize_slug("t")).alias("nn")
    )
    for r in df.collect():
        assert r["n"] == normalize(r["t"]), r
        assert r["nn"] == r["n"], r


def test_normalise_examples(spark):
    got = spark.createDataFrame([("  Ação__Brand#2!",), ("SMALL RING Brand#2",), ("ß",)], "t string").select(
        slug.normalize_slug("t").alias("n")
    )
    assert [r["n"] for r in got.collect()] == ["acao-brand-2", "small-ring-brand-2", ""]


def test_accent_table_is_rule_built():
    src, dst = slug.accent_fold_table()
    assert len(src) == len(dst) > 1000
    assert dict(zip(src, dst))["é"] == "e" and dict(zip(src, dst))["Ç"] == "C"


def test_levels_and_candidates(spark):
    df = spark.createDataFrame([("a",), ("a-1",), ("a-1-22",), ("2-3",), ("a-b",), ("",)], "s string")
    got = [r[0] for r in df.select(slug.slug_level("s")).collect()]
    assert got == [0, 1, 2, 1, 0, 0]
    r = spark.range(1).select(
        slug.suffixed_slug(F.lit("ab"), F.lit("7")).alias("x"),
        slug.product_path(F.lit("ab")).alias("p"),
        slug.product_path(F.lit(None).cast("string")).alias("q"),
        slug.is_numeric_sku(F.lit("x7")).alias("n"),
    ).first()
    assert (r["x"], r["p"], r["q"], r["n"]) == ("ab-7", "/ab/p", None, False)


def test_message_and_time_formatting(spark):
    r = spark.range(1).select(
        text.join_messages(F.lit(None).cast("string"), F.lit(None).cast("string")).alias("none"),
        text.join_messages(F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("ab"),
        text.format_elapsed(F.lit(3723)).alias("el"),
        text.format_elapsed(F.lit(0)).alias("zero"),
        text.format_run_ts(F.lit(None).cast("timestamp")).alias("dash"),
        text.format_run_ts(F.lit(dt.datetime(2024, 1, 2, 3, 4))).alias("ts"),
        text.local_clock(F.lit(dt.datetime(2024, 1, 2, 3, 4))).alias("clock"),
        text.template("x {} y {}", F.lit(1), F.lit(None)).alias("tpl"),
    ).first()
    assert r["none"] is None and r["ab"] == "a | b"
    assert (r["el"], r["zero"]) == ("01h 02m 03s", "00h 00m 00s")
    assert (r["dash"], r["ts"]) == ("—", "02/01/2024 03:04")
    assert r["clock"] == "01/01/2024 às 23:04"
    assert r["tpl"] == "x 1 y None"
