"""Redirect planning: removal of wrongful redirects, creation plan, outcomes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slugmend.functions.slug import product_path
from slugmend.functions.text import template
from slugmend.operators.lookup import lookup
from slugmend.operators.outcomes import failures_of, outcome_per, registry_per_path
from slugmend.schemas import (
    MSG_PROBE_FAILED,
    MSG_REDIRECT_FAILED,
    MSG_REDIRECT_SKIPPED,
    MSG_REMOVAL_FAILED,
    MSG_REMOVED,
    PROBE_REDIRECT,
    REDIRECT_HTTP_STATUS,
)

from slugmend.sources.cuts import materialise


def current_path(link: Column) -> Column:
    """Path probed for a wrongful redirect: the lower-cased current slug."""
    return product_path(F.lower(link))


def redirect_sources(link: Column, slug_final: Column) -> Column:
    """Ordered array of paths to redirect to ``/slug_final/p``.

    Exact current path first (unless it is the destination), then the
    lower-cased one (unless it is the destination or the exact path).
    """
    dest = product_path(slug_final)
    exact = product_path(link)
    lower = product_path(F.lower(link))
    return F.filter(
        F.array(
            F.when(exact != dest, exact),
            F.when((lower != dest) & (lower != exact), lower),
        ),
        lambda p: p.isNotNull(),
    )


def redirect_plan(df: DataFrame, *keys: str) -> DataFrame:
    """One row per redirect to create: ``(keys, seq, from_path, to_path, http_status)``.

    ``df`` has the keys (default ``product_id``), ``link_id`` (current slug) and
    ``slug_final``; 0-2 rows each.
    """
    keys = keys or ("product_id",)
    return df.select(
        *keys,
        product_path(F.col("slug_final")).alias("to_path"),
        F.posexplode(redirect_sources(F.col("link_id"), F.col("slug_final"))).alias("pos", "from_path"),
    ).select(
        *keys,
        (F.col("pos") + 1).alias("seq"),
        "from_path",
        "to_path",
        F.lit(REDIRECT_HTTP_STATUS).alias("http_status"),
    )


def redirect_outcome(plan_input: DataFrame, outcomes: DataFrame, key: str = "product_id") -> DataFrame:
    """Per key: did every redirect work, and if not, which path failed first.

    Attempts stop at the first failure; a plan without any path counts as
    done with a note. ``outcomes`` is ``(from_path, erro, msg)``; a path
    without an outcome row succeeds.
    """
    plan = redirect_plan(plan_input, key)
    tried = lookup(plan, outcome_per(outcomes, "from_path"), "from_path")
    first_fail = tried.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_planned"),
        F.min(F.when(F.coalesce("erro", F.lit(False)), F.struct("seq", "from_path", "msg"))).alias("fail"),
    )
    base = plan_input.select(key, product_path(F.col("slug_final")).alias("redirect_destino"))
    out = base.join(first_fail, key, "left")
    failed = F.col("fail").isNotNull()
    n_planned = F.coalesce(F.col("n_planned"), F.lit(0))
    return out.select(
        key,
        "redirect_destino",
        n_planned.alias("n_planejados"),
        F.when(failed, F.col("fail.seq") - 1).otherwise(n_planned).alias("n_criados"),
        (~failed).alias("redirect_confirmado"),
        F.col("fail.from_path").alias("path_falha"),
        F.when(failed, template(MSG_REDIRECT_FAILED, F.col("fail.from_path"), F.col("fail.msg")))
        .when(n_planned == 0, F.lit(MSG_REDIRECT_SKIPPED))
        .alias("mensagem"),
    )


def removal_note(exists: Column, removal_failed: Column, removal_msg: Column, old_target: Column) -> Column:
    """Observation text for a wrongful redirect found on the current path."""
    return F.when(
        exists,
        F.when(removal_failed, template(MSG_REMOVAL_FAILED, removal_msg)).otherwise(
            template(MSG_REMOVED, old_target)
        ),
    )


def wrongful_redirects(items: DataFrame, registry: DataFrame, removals: DataFrame) -> DataFrame:
    """Snapshot probe: does the current (lower-case) path of an item redirect?

    ``items`` has ``link_id``; ``registry`` is ``(from_path, to_path)``;
    ``removals`` is ``(from_path, erro, msg)``. Adds ``path_atual``,
    ``existe``, ``destino_antigo``, ``removido`` and ``observacao``.
    """
    probe = items.withColumn("path_atual", current_path(F.col("link_id")))
    reg = registry_per_path(registry).select(
        F.col("from_path").alias("path_atual"), F.col("to_path").alias("destino_antigo")
    )
    rem = outcome_per(removals, "from_path").select(
        F.col("from_path").alias("path_atual"), F.col("erro").alias("_rem_erro"), F.col("msg").alias("_rem_msg")
    )
    joined = lookup(probe, reg.join(rem, "path_atual", "full"), "path_atual")
    exists = F.col("destino_antigo").isNotNull()
    rem_failed = F.coalesce(F.col("_rem_erro"), F.lit(False))
    return joined.select(
        *items.columns,
        "path_atual",
        exists.alias("existe"),
        "destino_antigo",
        (exists & ~rem_failed).alias("removido"),
        removal_note(exists, rem_failed, F.col("_rem_msg"), F.col("destino_antigo")).alias("observacao"),
    )


# --- in-batch redirect timeline ---------------------------------------------------------
#
# Items run in queue order. Item k probes its current path (and removes a
# redirect found there) before later items act, and after its update it
# creates redirects from its old paths. So a probe can see a redirect that
# an earlier item created, or miss one that an earlier item removed. Per
# path, the events are ordered by (item order, phase): snapshot entries
# first, then per item its probe (phase 0) and its creations (phase 1, 2).
# A probe finds a redirect iff the latest snapshot/creation event before it
# is later than the latest probe that removed (or could have removed) it.

_SNAPSHOT, _ITEM = 0, 1


def redirect_timeline(
    checks: DataFrame,
    creates: DataFrame,
    registry: DataFrame,
    removals: DataFrame | None,
    bucket: Callable[[DataFrame], DataFrame] | None = None,
    failures: DataFrame | None = None,
) -> DataFrame:
    """Probe results for every check, given the in-batch creations.

    ``checks``: ``(item_id, okey, path_atual)``; ``creates``:
    ``(okey, seq, from_path, to_path)``; ``registry``: ``(from_path,
    to_path)``; ``removals``: ``(from_path, erro, msg)`` or ``None``;
    ``failures``: ``(kind, key, msg)``, paths whose probe fails: such a check
    sees nothing, removes nothing and leaves an observation.
    Returns ``(item_id, existe, destino_antigo, removal_failed, observacao)``.

    ``bucket`` adds a column ``b`` computed from ``okey``: a non-negative
    integer that never decreases along the queue order. The scan then runs in two levels, so
    that a path shared by a large share of the batch is not one task:
    per (path, bucket) maxima, a carry-in over the buckets of a path (few
    rows per path), and ordered windows inside each (path, bucket).
    Without ``bucket`` every path is one window partition.
    """
    cols = ["path", "flag", "okey", "phase", "to_path", "is_check", "item_id", "_rem_erro", "_rem_msg", "_unprobed"]
    probed = checks.select(F.col("path_atual").alias("path")).distinct()
    snap = registry_per_path(registry).select(F.col("from_path").alias("path"), "to_path").join(probed, "path", "left_semi")
    snap = snap.select(
        "path",
        F.lit(_SNAPSHOT).alias("flag"),
        F.lit(None).cast(checks.schema["okey"].dataType).alias("okey"),
        F.lit(-1).alias("phase"),
        "to_path",
        F.lit(False).alias("is_check"),
        F.lit(None).cast("string").alias("item_id"),
        F.lit(None).cast("boolean").alias("_rem_erro"),
        F.lit(None).cast("string").alias("_rem_msg"),
        F.lit(None).cast("string").alias("_unprobed"),
    )
    made = creates.select(F.col("from_path").alias("path"), "okey", "seq", "to_path").join(
        probed, "path", "left_semi"
    )
    made = made.select(
        "path",
        F.lit(_ITEM).alias("flag"),
        "okey",
        F.col("seq").cast("int").alias("phase"),
        "to_path",
        F.lit(False).alias("is_check"),
        F.lit(None).cast("string").alias("item_id"),
        F.lit(None).cast("boolean").alias("_rem_erro"),
        F.lit(None).cast("string").alias("_rem_msg"),
        F.lit(None).cast("string").alias("_unprobed"),
    )
    probes = checks.select(F.col("path_atual").alias("path"), "okey", F.col("item_id").cast("string"))
    if removals is not None:
        rem = outcome_per(removals, "from_path").select(
            F.col("from_path").alias("path"), F.col("erro").alias("_rem_erro"), F.col("msg").alias("_rem_msg")
        )
        probes = lookup(probes, rem, "path")
    else:
        probes = probes.withColumn("_rem_erro", F.lit(None).cast("boolean")).withColumn(
            "_rem_msg", F.lit(None).cast("string")
        )
    unprobed = failures_of(failures, PROBE_REDIRECT, "path", "_unprobed", checks)
    probes = probes.join(unprobed, "path", "left").select(
        "path",
        F.lit(_ITEM).alias("flag"),
        "okey",
        F.lit(0).alias("phase"),
        F.lit(None).cast("string").alias("to_path"),
        F.lit(True).alias("is_check"),
        "item_id",
        "_rem_erro",
        "_rem_msg",
        "_unprobed",
    )
    events = snap.select(*cols).unionByName(made.select(*cols)).unionByName(probes.select(*cols))
    rem_failed = F.coalesce(F.col("_rem_erro"), F.lit(False))
    key = F.struct("flag", "okey", "phase")
    set_ev = F.when(~F.col("is_check"), F.struct(key.alias("k"), F.col("to_path")))
    reset_ev = F.when(F.col("is_check") & ~rem_failed & F.col("_unprobed").isNull(), key)
    events = events.withColumn("b", F.lit(0)) if bucket is None else bucket(events)
    events = events.withColumn("b", F.when(F.col("flag") == _SNAPSHOT, F.lit(-1)).otherwise(F.col("b")))
    # Both levels read the events: written once, not derived twice.
    events = materialise(events, "events")
    # Level 1: what each (path, bucket) leaves behind, carried into later buckets.
    per_bucket = events.groupBy("path", "b").agg(F.max(set_ev).alias("bs"), F.max(reset_ev).alias("br"))
    over_buckets = Window.partitionBy("path").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        "path", "b", F.max("bs").over(over_buckets).alias("cs"), F.max("br").over(over_buckets).alias("cr")
    )
    # Level 2: ordered scan inside each (path, bucket).
    w = (
        Window.partitionBy("path", "b")
        .orderBy(F.col("flag"), F.col("okey").asc_nulls_first(), F.col("phase"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    scanned = (
        events.select(
            "path", "b", "item_id", "is_check", "_rem_erro", "_rem_msg", "_unprobed",
            F.max(set_ev).over(w).alias("ls_in"), F.max(reset_ev).over(w).alias("lr_in"),
        )
        .filter(F.col("is_check"))
        .join(carry, ["path", "b"], "left")
        .select(
            "item_id", "_rem_erro", "_rem_msg", "_unprobed",
            F.greatest("ls_in", "cs").alias("ls"), F.greatest("lr_in", "cr").alias("lr"),
        )
    )
    seen = F.col("ls").isNotNull() & (F.col("lr").isNull() | (F.col("ls.k") > F.col("lr")))
    exists = seen & F.col("_unprobed").isNull()
    failed = F.coalesce(F.col("_rem_erro"), F.lit(False))
    return scanned.select(
        "item_id",
        exists.alias("existe"),
        F.when(exists, F.col("ls.to_path")).alias("destino_antigo"),
        (exists & failed).alias("removal_failed"),
        F.coalesce(
            F.when(F.col("_unprobed").isNotNull(), template(MSG_PROBE_FAILED, F.col("_unprobed"))),
            removal_note(exists, failed, F.col("_rem_msg"), F.col("ls.to_path")),
        ).alias("observacao"),
        F.col("_unprobed").isNotNull().alias("nao_verificado"),
    )
