"""The status cascade: one log row per batch item, computed set-wise.

Per item the sequential job would: look up the product (error), read its
details (error), skip inactive products, normalise the slug, skip slugs
that are already right, probe and remove a wrongful redirect on the
current path (an observation, never an abort), resolve collisions, update
the slug (error), create the redirects (error) and report success. Here
each step is a join or an expression over the whole batch:

* lookups and the gate are left joins plus a ``when`` chain;
* collisions are settled level by level (``operators.collisions``);
* redirect probes see earlier items' removals and creations through a
  per-path timeline (``operators.redirects.redirect_timeline``);
* the status is the first rule that fires in one ``when`` chain.

A SKU listed several times runs several times in a row; the copies after
the first find the state the first copy left behind. Copies are counted,
not carried as rows, until the log rows are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slugmend.functions.slug import evaluated_once, normalize_slug, numeric_order_key, product_path
from slugmend.functions.text import join_messages, template
from slugmend.operators import collisions as C
from slugmend.operators.counts import expand_counts
from slugmend.operators.catalog import (
    TREAT,
    catalog_lookup,
    empty_slug_message,
    gate_column,
    products,
    rows_for_products,
)
from slugmend.operators.lookup import lookup
from slugmend.operators.outcomes import outcome_per
from slugmend.operators.redirects import current_path, redirect_outcome, redirect_plan, redirect_timeline
from slugmend.schemas import (
    BAD_SUFFIX,
    ERRO_API,
    ERRO_COLISAO_IRRESOLVIVEL,
    ERRO_PUT,
    ERRO_REDIRECT,
    MSG_COLLISION_PROBE_FAILED,
    MSG_IRRESOLVABLE,
    MSG_PUT_FAILED,
    MSG_SUFFIX_PROBE_FAILED,
    MSG_UNHANDLED,
    PULADO_INATIVO,
    PULADO_JA_CORRIGIDO,
    SUCESSO,
)
from slugmend.sources.cuts import materialise

LOOKUP_FAILED = "LOOKUP_FAILED"

# Order buckets of the redirect timeline scan (see redirect_timeline).
TIMELINE_BUCKETS = 1024


def order_key(sku: Column | str) -> Column:
    """Sortable struct equal to the queue order (numeric SKU, then text)."""
    c = F.col(sku) if isinstance(sku, str) else sku
    num = numeric_order_key(c)
    return F.struct(num.isNull().alias("nn"), num.alias("num"), c.alias("sku"))


def update_outcome(items: DataFrame, put: DataFrame) -> DataFrame:
    """Join the slug-update outcome per product (absent means it worked).

    Adds ``put_confirmado`` and ``mensagem`` (the ``ERRO_PUT`` text). Products
    are compared as text, and items without one are spread by their own value.
    """
    p = outcome_per(put, "product_id").select(
        F.col("product_id").cast("string").alias("_put_key"), F.col("erro").alias("_put_erro"), F.col("msg").alias("_put_msg")
    )
    failed = F.coalesce(F.col("_put_erro"), F.lit(False))
    key = F.coalesce(F.col("product_id").cast("string"), F.concat(F.lit("no product: "), F.col("sku_id").cast("string")))
    return lookup(items.withColumn("_put_key", key), p, "_put_key").select(
        *items.columns,
        (~failed).alias("put_confirmado"),
        F.when(failed, template(MSG_PUT_FAILED, F.col("_put_msg"))).alias("mensagem"),
    )


def batch_items(batch: DataFrame, sku_col: str = "sku_id") -> DataFrame:
    """Distinct SKUs of a batch with their copy count and order key.

    Partial aggregation first, so a SKU listed millions of times costs one
    row per map task in the shuffle. A batch that is already counted (an
    ``n_copies`` column, as from ``queue.queue_head``) is summed instead.
    """
    copies = F.sum("n_copies") if "n_copies" in batch.columns else F.count(F.lit(1))
    return (
        batch.filter(F.col(sku_col).isNotNull())
        .groupBy(F.col(sku_col).cast("string").alias("sku_id"))
        .agg(copies.cast("bigint").alias("n_copies"))
        .withColumn("okey", order_key("sku_id"))
    )


def enrich(
    items: DataFrame, catalog: DataFrame, put: DataFrame | None, failures: DataFrame | None = None
) -> DataFrame:
    """Lookup, gate and update outcome per item (steps before any probe)."""
    look = catalog_lookup(items, catalog, failures=failures, one_row_per_sku=True)
    look = look.select("*", evaluated_once(normalize_slug(F.col("link_id"))).alias("_norm"))
    norm = F.col("_norm")
    gate = F.when(F.col("erro"), F.lit(LOOKUP_FAILED)).otherwise(
        gate_column(F.col("link_id"), norm, F.col("is_active"))
    )
    out = look.select(
        *items.columns,
        "product_id",
        "link_id",
        "is_active",
        F.col("mensagem").alias("lookup_msg"),
        F.when(~F.col("erro") & F.coalesce(F.col("is_active"), F.lit(False)), norm).alias("slug_norm"),
        gate.alias("gate"),
    )
    if put is None:
        return out.withColumn("put_ok", F.lit(True)).withColumn("put_text", F.lit(None).cast("string"))
    return update_outcome(out, put).withColumnsRenamed({"put_confirmado": "put_ok", "mensagem": "put_text"})


def batch_cuts(enriched: DataFrame, n_buckets: int = TIMELINE_BUCKETS) -> dict[str, list[float]]:
    """Approximate quantiles of the queue position, the timeline's bucket splits.

    Numeric SKUs are placed by their value; the others, which come after them in
    text order, by the start of their text read as a number (``text_rank``). At
    most ``n_buckets - 1`` numbers of either kind reach the driver.
    """
    probs = [i / n_buckets for i in range(1, n_buckets)]
    if not probs:
        return {"num": [], "text": []}
    placed = enriched.select(
        F.col("okey.num").cast("double").alias("num"), F.when(F.col("okey.num").isNull(), text_rank("okey.sku")).alias("text")
    )
    num, text = placed.approxQuantile(["num", "text"], probs, 1.0 / (4 * n_buckets))
    return {"num": num, "text": text}


def text_rank(sku: str) -> Column:
    """A number that never decreases along the text order: the first six bytes of the UTF-8 text."""
    head = F.rpad(F.substring(F.hex(F.encode(F.col(sku), "UTF-8")), 1, 12), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def order_buckets(cuts: dict[str, list[float]]):
    """Equal-count buckets of the queue order, as a DataFrame transform.

    The approximate quantiles of :func:`batch_cuts` become the splits of a
    ``Bucketizer`` (a binary search per row, on the JVM). A range where many
    items sit gets proportionally many buckets, so a path shared by a large
    share of the batch is cut into many buckets whatever the SKU distribution.
    Buckets of non-numeric SKUs (which sort last) follow those of the numeric
    ones. The transform adds ``b`` from ``okey``.
    """
    from pyspark.ml.feature import Bucketizer

    def splits(kind: str) -> list[float]:
        return [float("-inf"), *sorted(set(cuts.get(kind) or [])), float("inf")]

    def placed(df: DataFrame, kind: str, value: Column) -> DataFrame:
        at = splits(kind)
        if len(at) < 3:  # one bucket
            return df.withColumn(f"_b_{kind}", F.when(value.isNotNull(), F.lit(0.0)))
        bucketizer = Bucketizer(splits=at, inputCol=f"_{kind}", outputCol=f"_b_{kind}", handleInvalid="keep")
        return bucketizer.transform(df.withColumn(f"_{kind}", value)).drop(f"_{kind}")

    after = len(splits("num"))

    def apply(df: DataFrame) -> DataFrame:
        num = F.col("okey.num").cast("double")
        out = placed(placed(df, "num", num), "text", F.when(num.isNull(), text_rank("okey.sku")))
        numeric, text = F.col("_b_num").cast("int"), F.col("_b_text").cast("int") + after
        return out.withColumn("b", F.when(num.isNotNull(), numeric).otherwise(F.coalesce(text, F.lit(after)))).drop("_b_num", "_b_text")

    return apply


def resolve(enriched: DataFrame, catalog: DataFrame, failures: DataFrame | None = None) -> DataFrame:
    """Collision outcome per treated item (``collisions.RESOLUTION_COLUMNS``).

    Only products holding a candidate slug are aggregated (semi joins on the
    link, then on the product), not the whole catalogue.
    """
    claims = enriched.filter(F.col("gate") == TREAT).select(
        F.col("sku_id").alias("item_id"),
        "okey",
        "product_id",
        F.col("sku_id").alias("sku"),
        F.col("slug_norm").alias("slug"),
        F.col("put_ok").alias("eligible"),
    )
    cands = C.candidate_slugs(claims)
    holding = catalog.join(cands, catalog["link_id"] == cands["slug"], "left_semi")
    prods = products(rows_for_products(catalog, holding))
    return C.resolve_claims(C.prepare_claims(claims, prods, failures))


def join_decisions(enriched: DataFrame, decisions: DataFrame) -> DataFrame:
    """The enriched batch with each item's collision outcome (left join on the item)."""
    dec = decisions.drop("product_id")
    if "item_id" in dec.columns:
        dec = dec.withColumnRenamed("item_id", "sku_id")
    return enriched.join(dec, "sku_id", "left")


def item_outcomes(
    items: DataFrame,
    registry: DataFrame,
    redirect_out: DataFrame | None,
    removals: DataFrame | None,
    bucket=None,
    failures: DataFrame | None = None,
) -> DataFrame:
    """First-copy log fields per item (``items`` from :func:`join_decisions`)."""
    won = items.filter(F.col("outcome") == C.WIN)
    if redirect_out is None:
        redirect_out = items.sparkSession.createDataFrame([], "from_path string, erro boolean, msg string")
    # Redirects stop at the first that fails; those before it exist for later items.
    outcome = redirect_outcome(won, redirect_out, key="sku_id").select(
        "sku_id", "n_criados", "redirect_confirmado", F.col("mensagem").alias("redirect_msg")
    )
    items = materialise(items.join(outcome, "sku_id", "left"), "redirected")
    done = items.filter(F.col("outcome") == C.WIN)
    creates = redirect_plan(done, "okey", "n_criados").filter(F.col("seq") <= F.col("n_criados")).select(
        "okey", "seq", "from_path", "to_path"
    )
    # Wrongful-redirect probe of every item that reaches it.
    checks = items.filter(
        (F.col("gate") == TREAT) & (F.col("outcome") != C.FIXED_BEFORE)
    ).select(F.col("sku_id").alias("item_id"), "okey", current_path(F.col("link_id")).alias("path_atual"))
    probes = redirect_timeline(checks, creates, registry, removals, bucket, failures)
    return items.join(probes.withColumnRenamed("item_id", "sku_id"), "sku_id", "left")


def first_copy_rows(items: DataFrame) -> DataFrame:
    """Status cascade and log fields for the first copy of each item."""
    gate = F.col("gate")
    outcome = F.col("outcome")
    obs = F.col("observacao")
    fixed_before = (gate == TREAT) & (outcome == C.FIXED_BEFORE)
    won = (gate == TREAT) & (outcome == C.WIN)
    red_failed = won & ~F.col("redirect_confirmado")
    probed = (gate == TREAT) & ~fixed_before

    status = (
        F.when(gate == LOOKUP_FAILED, F.lit(ERRO_API))
        .when(gate == PULADO_INATIVO, F.lit(PULADO_INATIVO))
        .when(gate == ERRO_API, F.lit(ERRO_API))
        .when(gate == PULADO_JA_CORRIGIDO, F.lit(PULADO_JA_CORRIGIDO))
        .when(fixed_before, F.lit(PULADO_JA_CORRIGIDO))
        .when(outcome.isin(C.BAD_SUFFIX, C.PROBE_FAILED, C.SUFFIX_PROBE_FAILED), F.lit(ERRO_API))
        .when(outcome == C.IRRESOLVABLE, F.lit(ERRO_COLISAO_IRRESOLVIVEL))
        .when(outcome == C.PUT_FAIL, F.lit(ERRO_PUT))
        .when(red_failed, F.lit(ERRO_REDIRECT))
        .when(won, F.lit(SUCESSO))
        .otherwise(F.lit(ERRO_API))
    )
    error_text = (
        F.when(gate == LOOKUP_FAILED, F.col("lookup_msg"))
        .when(gate == ERRO_API, empty_slug_message())
        .when(outcome == C.BAD_SUFFIX, template(MSG_UNHANDLED, F.lit("ValueError"), F.lit(BAD_SUFFIX)))
        .when(outcome == C.IRRESOLVABLE, template(MSG_IRRESOLVABLE, F.col("product_id_conflitante")))
        .when(outcome == C.PROBE_FAILED, template(MSG_COLLISION_PROBE_FAILED, F.col("probe_msg")))
        .when(outcome == C.SUFFIX_PROBE_FAILED, template(MSG_SUFFIX_PROBE_FAILED, F.col("probe_msg")))
        .when(outcome == C.PUT_FAIL, F.col("put_text"))
        .when(red_failed, F.col("redirect_msg"))
    )
    # Without a path to redirect, the redirect step leaves its note after the observations.
    message = join_messages(error_text, obs, F.when(won & ~red_failed, F.col("redirect_msg")))
    reached_details = gate != LOOKUP_FAILED
    active = gate.isin(TREAT, ERRO_API, PULADO_JA_CORRIGIDO)
    slug_orig = F.when(fixed_before, F.col("fixed_slug")).when(reached_details, F.col("link_id"))
    slug_norm = F.when(fixed_before, F.col("fixed_slug")).when(active, F.col("slug_norm"))
    return items.select(
        "sku_id",
        "okey",
        "n_copies",
        "product_id",
        slug_orig.alias("slug_original"),
        slug_norm.alias("slug_normalizado"),
        F.when(gate == TREAT, F.col("slug_final")).alias("slug_final"),
        F.coalesce(F.when(probed, F.col("houve_colisao")), F.lit(False)).alias("houve_colisao"),
        F.when(probed, F.col("product_id_conflitante")).alias("product_id_conflitante"),
        F.when(reached_details, F.col("is_active")).alias("is_active"),
        status.alias("status"),
        won.alias("put_confirmado"),
        (won & ~red_failed).alias("redirect_confirmado"),
        F.when(won, product_path(F.col("slug_final"))).alias("redirect_destino"),
        message.alias("mensagem_erro"),
        F.when(F.coalesce(F.col("removal_failed") | F.col("nao_verificado"), F.lit(False)), obs).alias("_repeat_obs"),
        error_text.alias("_error_text"),
        probed.alias("_probed"),
    )


def repeat_rows(first: DataFrame) -> DataFrame:
    """Rows for copies 2..n of each SKU, as the state after copy 1 dictates.

    After an update went through, the copies find the slug right. After a
    failure before the update, the copies fail the same way; a wrongful
    redirect is only seen again when its removal failed. Copies of other
    outcomes repeat the first row. Large copy counts are cut into chunks
    that are spread over tasks before they are expanded.
    """
    multi = first.filter(F.col("n_copies") > 1)
    updated = F.col("put_confirmado")
    failed_before_update = F.col("status").isin(ERRO_PUT, ERRO_COLISAO_IRRESOLVIVEL) | (
        (F.col("status") == ERRO_API) & F.col("slug_final").isNull() & F.col("_probed")
    )
    keep_all = ~updated
    rows = multi.select(
        "sku_id",
        "n_copies",
        "product_id",
        F.when(updated, F.col("slug_final")).otherwise(F.col("slug_original")).alias("slug_original"),
        F.when(updated, F.col("slug_final")).otherwise(F.col("slug_normalizado")).alias("slug_normalizado"),
        F.when(keep_all, F.col("slug_final")).alias("slug_final"),
        F.when(keep_all, F.col("houve_colisao")).otherwise(F.lit(False)).alias("houve_colisao"),
        F.when(keep_all, F.col("product_id_conflitante")).alias("product_id_conflitante"),
        "is_active",
        F.when(updated, F.lit(PULADO_JA_CORRIGIDO)).otherwise(F.col("status")).alias("status"),
        F.lit(False).alias("put_confirmado"),
        F.lit(False).alias("redirect_confirmado"),
        F.lit(None).cast("string").alias("redirect_destino"),
        F.when(updated, F.lit(None).cast("string"))
        .when(failed_before_update, join_messages(F.col("_error_text"), F.col("_repeat_obs")))
        .otherwise(F.col("mensagem_erro"))
        .alias("mensagem_erro"),
    )
    return expand_counts(rows.withColumn("_repeats", F.col("n_copies") - 1).drop("n_copies"), "_repeats", ["sku_id"])
