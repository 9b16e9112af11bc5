"""Slug collisions and their resolution without a sequential loop.

The sequential job gives each treated item its normalised slug, or, when
another product holds it, ``slug-sku``; if that is taken too the item is
irresolvable. Probes read the live catalogue, so an earlier item's claim
blocks a later one. The same result is computed set-wise:

* A probe only ever asks about normalised slugs, and a product only gives
  up its slug when that slug is not normalised, so snapshot holders stay
  valid for the whole batch; only claims made in the batch are added.
* The *level* of a slug is its number of trailing ``-<digits>`` groups. A
  suffixed candidate lies exactly one level above its plain slug and keeps its
  *stem* (the slug without those groups), so claims only meet within a stem.
  Levels of a stem are settled in ascending order, counted from the stem's
  lowest one, and all stems at once, each step with a few aggregations and joins
  keyed by slug or product (partial aggregation, no global sort). The number of
  steps is that of the levels which one stem has, mostly one, whatever levels occur.
* Within a level, the first eligible plain claimant of a slug (by queue
  order) takes it unless a suffixed claimant of another product that comes
  earlier took it; a product is fixed by its first item that takes a slug,
  and later items of that product find their slug already right.

Items carry an order key ``okey`` (a struct that sorts like the queue).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slugmend.functions.slug import is_numeric_sku, slug_level, slug_stem, suffixed_slug
from slugmend.operators.lookup import lookup
from slugmend.operators.outcomes import failures_of
from slugmend.schemas import PROBE_SLUG
from slugmend.sources.cuts import materialise

# claim outcomes
WIN = "WIN"                    # took the slug; its update succeeds
PUT_FAIL = "PUT_FAIL"          # slug free, but the update fails
FIXED_BEFORE = "FIXED_BEFORE"  # an earlier item of the product already fixed it
IRRESOLVABLE = "IRRESOLVABLE"  # plain and suffixed slug both taken
BAD_SUFFIX = "BAD_SUFFIX"      # plain slug taken and the SKU cannot form a slug suffix
PROBE_FAILED = "PROBE_FAILED"  # the plain slug could not be probed
SUFFIX_PROBE_FAILED = "SUFFIX_PROBE_FAILED"  # plain slug taken, the suffixed one could not be probed

RESOLUTION_COLUMNS = (
    "item_id",
    "product_id",
    "outcome",
    "houve_colisao",
    "product_id_conflitante",
    "slug_final",
    "fixed_slug",
    "probe_msg",
)


def snapshot_holders(products: DataFrame) -> DataFrame:
    """``(slug, h_min, h_max)``: lowest and highest product id holding each link."""
    return products.filter(F.col("link_id").isNotNull()).groupBy(F.col("link_id").alias("slug")).agg(
        F.min("product_id").alias("h_min"), F.max("product_id").alias("h_max")
    )


def other_holder(h_min: Column, h_max: Column, own: Column) -> Column:
    """A holder different from ``own`` (the lowest such), else null."""
    return F.when(h_min != own, h_min).when(h_max != own, h_max)


def snapshot_collisions(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items ``(…, product_id, slug_normalizado)`` with the snapshot probe result.

    Adds ``colisao`` and ``product_id_conflitante`` (another product whose
    current link equals the normalised slug).
    """
    holders = snapshot_holders(products).withColumnRenamed("slug", "slug_normalizado")
    joined = lookup(items, holders, "slug_normalizado")
    conflict = other_holder(F.col("h_min"), F.col("h_max"), F.col("product_id"))
    return joined.select(
        *items.columns,
        conflict.isNotNull().alias("colisao"),
        conflict.alias("product_id_conflitante"),
    )


def candidate_slugs(claims: DataFrame) -> DataFrame:
    """Every slug a claim may ask about: plain and suffixed candidates."""
    plain = claims.select(F.col("slug").alias("slug"))
    sfx = claims.filter(is_numeric_sku(F.col("sku"))).select(suffixed_slug(F.col("slug"), F.col("sku")).alias("slug"))
    return plain.unionByName(sfx).distinct()


def prepare_claims(claims: DataFrame, products: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Attach both candidates, their levels, snapshot holders and failed probes to each claim.

    ``claims``: ``(item_id, okey, product_id, sku, slug, eligible)`` for the
    items that reach the collision check (one row per item). Both candidates
    go through one lookup of ``(slug)``, as two rows, and come back as columns:
    the catalogue's holders are derived and joined once. ``products`` may
    already be cut to the products holding a candidate.
    """
    base = claims.select(
        "item_id",
        "okey",
        "product_id",
        "eligible",
        F.col("slug").alias("slug1"),
        slug_level(F.col("slug")).alias("lvl"),
        F.when(is_numeric_sku(F.col("sku")), suffixed_slug(F.col("slug"), F.col("sku"))).alias("slug2"),
    )
    kept = ["item_id", "okey", "product_id", "eligible", "slug1", "lvl", "slug2"]
    asked = base.select(*kept, F.explode(F.filter(F.array("slug1", "slug2"), lambda s: s.isNotNull())).alias("slug"))
    probed = lookup(asked, snapshot_holders(products), "slug").join(
        failures_of(failures, PROBE_SLUG, "slug", "failed", claims), "slug", "left"
    )
    holder = other_holder(F.col("h_min"), F.col("h_max"), F.col("product_id"))
    plain = F.col("slug") == F.col("slug1")
    return probed.groupBy(*kept).agg(
        F.max(F.when(plain, holder)).alias("snap1"),
        F.max(F.when(~plain, holder)).alias("snap2"),
        F.max(F.when(plain, F.col("failed"))).alias("failed1"),
        F.max(F.when(~plain, F.col("failed"))).alias("failed2"),
    )


_LEVEL_COLUMNS = [
    "item_id", "product_id", "okey", "eligible", "outcome", "houve_colisao",
    "product_id_conflitante", "slug_final", "slug", "snap", "probe_msg",
]
PUSH = "PUSH"  # not settled at this level: claims its suffixed slug one level up


def _settle_level(plain: DataFrame | None, pushed: DataFrame | None) -> DataFrame:
    """Settle one level (``plain`` or ``pushed`` may be absent).

    Returns one frame: terminal decisions, plus rows with outcome ``PUSH``
    that carry a blocked plain claim (``slug``, ``snap``) to the next level.
    """
    if plain is None:
        assert pushed is not None
        # no plain claim at this level: a suffixed claim is blocked only by the snapshot
        plain = pushed.select(
            F.lit(None).cast("string").alias("slug1"),
            F.lit(False).alias("eligible"),
            "okey",
            "product_id",
            "item_id",
        ).limit(0)
        plain_empty = True
    else:
        plain_empty = False
    # Earliest eligible plain claimant of each slug, with its product.
    first_plain = plain.groupBy(F.col("slug1").alias("slug")).agg(
        F.min(F.when(F.col("eligible"), F.struct("okey", "product_id"))).alias("wp")
    )
    parts: list[DataFrame] = []
    suffix_wins = None
    if pushed is not None:
        # A claim without a probed suffix (no numeric SKU, or a failed probe) takes nothing,
        # but still learns whether an earlier item fixed its product. It has no key to meet.
        open_ = pushed.filter(F.col("slug").isNotNull()).join(first_plain, "slug", "left")
        no_winner = F.lit(None).cast(first_plain.schema["wp"].dataType)
        shut = pushed.filter(F.col("slug").isNull()).withColumn("wp", no_winner)
        sfx = open_.unionByName(shut.select(*open_.columns))
        taken = F.col("snap").isNotNull() | (F.col("wp").isNotNull() & (F.col("wp.okey") < F.col("okey")))
        sfx = sfx.withColumn("blocked", F.col("slug").isNull() | taken)
        fix = (
            sfx.filter(F.col("eligible") & ~F.col("blocked"))
            .groupBy("product_id")
            .agg(F.min("okey").alias("fix_okey"))
        )
        sfx = sfx.join(fix, "product_id", "left")
        outcome = (
            F.when(F.col("fix_okey").isNotNull() & (F.col("okey") > F.col("fix_okey")), F.lit(FIXED_BEFORE))
            .when(F.col("fix_okey").isNotNull() & (F.col("okey") == F.col("fix_okey")), F.lit(WIN))
            .when(F.col("slug").isNull() & F.col("probe_msg").isNotNull(), F.lit(SUFFIX_PROBE_FAILED))
            .when(F.col("slug").isNull(), F.lit(BAD_SUFFIX))
            .when(F.col("blocked"), F.lit(IRRESOLVABLE))
            .otherwise(F.lit(PUT_FAIL))
        )
        sfx = sfx.withColumn("outcome", outcome)
        parts.append(
            sfx.select(
                "item_id",
                "product_id",
                "okey",
                "eligible",
                "outcome",
                # an item after its product's fix never probes
                (F.col("outcome") != FIXED_BEFORE).alias("houve_colisao"),
                F.when(F.col("outcome") != FIXED_BEFORE, F.col("product_id_conflitante")).alias(
                    "product_id_conflitante"
                ),
                F.when(F.col("outcome").isin(WIN, PUT_FAIL), F.col("slug")).alias("slug_final"),
                "slug",
                F.lit(None).cast("bigint").alias("snap"),
                F.when(F.col("outcome") == SUFFIX_PROBE_FAILED, F.col("probe_msg")).alias("probe_msg"),
            )
        )
        suffix_wins = sfx.filter(F.col("outcome") == WIN).select(
            "slug", F.struct("okey", "product_id").alias("sw")
        )
        if plain_empty:
            return parts[0].select(*_LEVEL_COLUMNS)

    p = plain.join(first_plain, plain["slug1"] == first_plain["slug"], "left").drop("slug")
    if suffix_wins is not None:
        p = p.join(suffix_wins, p["slug1"] == suffix_wins["slug"], "left").drop("slug")
        win = F.least(F.col("wp"), F.col("sw"))
    else:
        win = F.col("wp")
    p = p.withColumn("win", win)
    snap = F.col("snap1").isNotNull()
    before = F.col("win").isNotNull() & (F.col("win.okey") < F.col("okey"))
    same_product = F.col("win.product_id") == F.col("product_id")
    blocked = snap | (before & ~same_product)
    conflict = F.when(snap, F.col("snap1")).when(blocked, F.col("win.product_id"))
    outcome = (
        F.when(blocked, F.lit(PUSH))
        .when(before & same_product, F.lit(FIXED_BEFORE))
        .when(F.col("win.okey") == F.col("okey"), F.lit(WIN))
        .otherwise(F.lit(PUT_FAIL))
    )
    p = p.withColumn("outcome", outcome)
    pushing = F.col("outcome") == PUSH
    parts.append(
        p.select(
            "item_id",
            "product_id",
            "okey",
            "eligible",
            "outcome",
            pushing.alias("houve_colisao"),
            conflict.alias("product_id_conflitante"),
            F.when(F.col("outcome").isin(WIN, PUT_FAIL), F.col("slug1")).alias("slug_final"),
            F.when(pushing & F.col("failed2").isNull(), F.col("slug2")).alias("slug"),
            F.when(pushing, F.col("snap2")).alias("snap"),
            F.when(pushing, F.col("failed2")).alias("probe_msg"),
        )
    )
    out = parts[0].select(*_LEVEL_COLUMNS)
    for part in parts[1:]:
        out = out.unionByName(part.select(*_LEVEL_COLUMNS))
    return out


def _steps(claims: DataFrame) -> DataFrame:
    """``claims`` with ``step``: how far a claim's level lies above the lowest one of its stem.

    Only stems with several levels, which are few, are written and joined.
    """
    stem = claims.withColumn("stem", slug_stem("slug1"))
    several = (
        stem.groupBy("stem").agg(F.min("lvl").alias("low"), F.max("lvl").alias("high"))
        .filter(F.col("low") < F.col("high")).select("stem", "low")
    )
    joined = stem.join(materialise(several, "stems"), "stem", "left")
    return joined.withColumn("step", F.coalesce(F.col("lvl") - F.col("low"), F.lit(0))).drop("stem", "low")


def resolve_claims(prepared: DataFrame) -> DataFrame:
    """Settle every claim; one row per item with ``RESOLUTION_COLUMNS``
    (``fixed_slug``: the slug the item's product took in the batch, if any).

    ``prepared`` comes from :func:`prepare_claims` and is written here once.
    Only steps that have claims, and the steps that blocked claims move up
    to, are settled; each step's output is written once (a lineage cut per
    step), so the plan does not grow with their number. A slug whose
    own probe fails stops every item of its products, and settles none.
    """
    prepared = materialise(prepared, "claims")
    unprobed = prepared.filter(F.col("failed1").isNotNull()).select(
        "item_id", "product_id", "okey", "eligible", F.lit(PROBE_FAILED).alias("outcome"),
        F.lit(False).alias("houve_colisao"), F.lit(None).cast("bigint").alias("product_id_conflitante"),
        F.lit(None).cast("string").alias("slug_final"), F.lit(None).cast("string").alias("slug"),
        F.lit(None).cast("bigint").alias("snap"), F.col("failed1").alias("probe_msg"),
    )
    open_ = materialise(_steps(prepared.filter(F.col("failed1").isNull())), "open-claims")
    levels = sorted(r["step"] for r in open_.select("step").distinct().collect())
    settled: list[DataFrame] = [unprobed]
    pushed: DataFrame | None = None
    pushed_level = None

    def settle(plain: DataFrame | None, blocked: DataFrame | None, level: int) -> DataFrame | None:
        """Settle one level; returns the claims that move up, if any."""
        out = materialise(_settle_level(plain, blocked), f"level{level}")
        settled.append(out.filter(F.col("outcome") != PUSH))
        up = out.filter(F.col("outcome") == PUSH)
        return None if plain is None or up.isEmpty() else up

    for level in levels:
        if pushed is not None and pushed_level != level:
            settle(None, pushed, pushed_level)
            pushed = None
        pushed = settle(open_.filter(F.col("step") == level), pushed, level)
        pushed_level = level + 1
    if pushed is not None:
        settle(None, pushed, pushed_level)
    decided = settled[0]
    for part in settled[1:]:
        decided = decided.unionByName(part)
    # A product is fixed at most once; its items after the fix see that slug.
    wins = decided.filter(F.col("outcome") == WIN).select("product_id", F.col("slug_final").alias("fixed_slug"))
    return decided.join(wins, "product_id", "left").select(*RESOLUTION_COLUMNS)
