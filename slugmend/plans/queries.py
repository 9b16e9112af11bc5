"""Registered queries: one callable ``(spark, data_dir) -> DataFrame`` each.

Each query builds its scenario tables from the data folder with
``slugmend.sources.fixtures`` and applies one operator (or the whole
correction / report plan) to them. ``slugmend.plans.oracle`` holds the
DuckDB SQL for the same results.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slugmend.functions.slug import normalize_slug
from slugmend.operators import catalog as cat_ops
from slugmend.operators import collisions, queue, redirects, report
from slugmend.operators.cascade import update_outcome
from slugmend.plans import correction
from slugmend.sources import cuts
from slugmend.sources.cuts import materialise
from slugmend.sources.finalkeys import final_keys, merge_final_keys
from slugmend.sources.runfacts import record_runs, run_facts
from slugmend.sources import fixtures as fx
from slugmend.schemas import DEFAULT_BATCH_SIZE

Query = Callable[[SparkSession, str], DataFrame]


# --- queue -------------------------------------------------------------------------

def q_queue_next(spark: SparkSession, d: str) -> DataFrame:
    return queue.queue_next(fx.queue_src(spark, d), fx.run_log(spark, d), DEFAULT_BATCH_SIZE)


def q_finalized_skus(spark: SparkSession, d: str) -> DataFrame:
    return queue.finalized_skus(fx.run_log(spark, d))


# More listings than any queue here has.
LARGE_BATCH = 1_000_000_000
# A batch size that ends between the two copies of SKU 1100 at sf0.01, so
# the head takes one copy of it.
HEAD_BATCH = 1010


def q_queue_head(spark: SparkSession, d: str) -> DataFrame:
    """The large-batch path of queue selection: counted head of the queue."""
    return queue.queue_head(fx.queue_src(spark, d), fx.run_log(spark, d), HEAD_BATCH)


def q_queue_shortfall(spark: SparkSession, d: str) -> DataFrame:
    batch = queue.queue_next(fx.queue_src(spark, d), fx.run_log(spark, d), DEFAULT_BATCH_SIZE)
    return queue.queue_shortfall(batch, DEFAULT_BATCH_SIZE)


def q_queue_shortfall_whole(spark: SparkSession, d: str) -> DataFrame:
    """A batch larger than the queue."""
    batch = queue.queue_next(fx.queue_src(spark, d), fx.run_log(spark, d), LARGE_BATCH)
    return queue.queue_shortfall(batch, LARGE_BATCH)


def _index(spark: SparkSession, d: str) -> DataFrame:
    """The index of final SKUs, built from the log."""
    path = cuts.new_path(spark, "final-keys")
    merge_final_keys(fx.run_log(spark, d), path)
    return final_keys(spark, path)


def q_final_key_index(spark: SparkSession, d: str) -> DataFrame:
    return _index(spark, d)


def q_queue_next_indexed(spark: SparkSession, d: str) -> DataFrame:
    """The next batch by the index of final SKUs instead of the log."""
    log = fx.run_log(spark, d)
    return queue.queue_next(fx.queue_src(spark, d), log, DEFAULT_BATCH_SIZE, final_keys=_index(spark, d))


def q_retryable_skus(spark: SparkSession, d: str) -> DataFrame:
    return queue.retryable_skus(fx.run_log(spark, d))


# --- report ------------------------------------------------------------------------

def q_effective_time(spark: SparkSession, d: str) -> DataFrame:
    log = fx.run_log(spark, d)
    return report.with_effective_time(log).select("execution_id", "sku_vtex", "status", "effective_ts")


def q_run_last_seen(spark: SparkSession, d: str) -> DataFrame:
    return report.run_last_seen(fx.run_log(spark, d))


def q_latest_run(spark: SparkSession, d: str) -> DataFrame:
    return report.latest_run(fx.run_log(spark, d))


def _facts(spark: SparkSession, d: str) -> DataFrame:
    """The facts of a log's runs, recorded beside it."""
    log, path = fx.run_log(spark, d), cuts.new_path(spark, "log")
    log.write.partitionBy("execution_id").parquet(path)
    cuts.keep(spark, path, log.schema)
    record_runs(spark, path)
    return run_facts(spark, path)


def q_run_facts(spark: SparkSession, d: str) -> DataFrame:
    return _facts(spark, d)


def q_latest_run_recorded(spark: SparkSession, d: str) -> DataFrame:
    return report.latest_recorded_run(_facts(spark, d))


def q_status_frequency_recorded(spark: SparkSession, d: str) -> DataFrame:
    return report.recorded_status_frequency(_facts(spark, d))


def q_run_summary(spark: SparkSession, d: str) -> DataFrame:
    return report.run_summaries(fx.run_log(spark, d))


def q_latest_run_summary(spark: SparkSession, d: str) -> DataFrame:
    return report.latest_run_summary(fx.run_log(spark, d))


def q_run_severity(spark: SparkSession, d: str) -> DataFrame:
    return report.run_severity(report.run_summaries(fx.run_log(spark, d)))


def q_report_metrics(spark: SparkSession, d: str) -> DataFrame:
    return report.report_metrics(report.run_summaries(fx.run_log(spark, d)))


def q_run_header(spark: SparkSession, d: str) -> DataFrame:
    return report.run_header(report.run_summaries(fx.run_log(spark, d)))


def q_status_frequency(spark: SparkSession, d: str) -> DataFrame:
    return report.status_frequency(fx.run_log(spark, d))


def q_critical_skus(spark: SparkSession, d: str) -> DataFrame:
    return report.critical_skus(fx.run_log(spark, d))


def q_critical_alert(spark: SparkSession, d: str) -> DataFrame:
    return report.critical_alert(fx.run_log(spark, d))


# --- slugs and catalogue -------------------------------------------------------------

def q_slug_normalize(spark: SparkSession, d: str) -> DataFrame:
    return fx.slug_texts(spark, d).select("src", "src_id", normalize_slug(F.col("text")).alias("slug"))


def q_slug_gate(spark: SparkSession, d: str) -> DataFrame:
    return cat_ops.slug_gate(fx.catalog(spark, d))


def q_catalog_lookup(spark: SparkSession, d: str) -> DataFrame:
    src = fx.queue_src(spark, d).filter(F.col("sku_id").isNotNull())
    return cat_ops.catalog_lookup(src, fx.catalog(spark, d))


def q_catalog_lookup_pruned(spark: SparkSession, d: str) -> DataFrame:
    """A catalogue with whole-number SKUs against text SKUs, one of them no number."""
    cat = fx.catalog(spark, d).filter(F.col("sku_id").rlike("^[0-9]+$")).withColumn("sku_id", F.col("sku_id").cast("bigint"))
    src = fx.queue_src(spark, d).filter(F.col("sku_id").isNotNull()).distinct()
    return cat_ops.catalog_lookup(src, cat)


def _treated(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue SKUs that pass the gate (active, slug not yet right)."""
    gate = cat_ops.slug_gate(fx.catalog(spark, d))
    return gate.filter(F.col("gate") == cat_ops.TREAT)


def q_slug_collisions(spark: SparkSession, d: str) -> DataFrame:
    cat = fx.catalog(spark, d)
    items = _treated(spark, d).select("sku_id", "product_id", "slug_normalizado")
    return collisions.snapshot_collisions(items, cat_ops.products(cat))


def q_update_outcome(spark: SparkSession, d: str) -> DataFrame:
    cat = fx.catalog(spark, d)
    items = _treated(spark, d).select("sku_id", "product_id")
    return update_outcome(items, fx.put_outcome(cat))


def _treated_products(spark: SparkSession, d: str) -> DataFrame:
    t = _treated(spark, d)
    return (
        t.select("product_id", F.col("slug_original").alias("link_id"), F.col("slug_normalizado").alias("slug_final"))
        .distinct()
    )


def q_redirect_plan(spark: SparkSession, d: str) -> DataFrame:
    return redirects.redirect_plan(_treated_products(spark, d))


def q_redirect_outcome(spark: SparkSession, d: str) -> DataFrame:
    cat = fx.catalog(spark, d)
    return redirects.redirect_outcome(_treated_products(spark, d), fx.redirect_outcome(cat))


def q_wrongful_redirects(spark: SparkSession, d: str) -> DataFrame:
    cat = fx.catalog(spark, d)
    items = _treated(spark, d).select("sku_id", "product_id", F.col("slug_original").alias("link_id"))
    return redirects.wrongful_redirects(items, fx.redirects(cat), fx.removal_outcome(cat))


QUERIES: dict[str, Query] = {
    "queue_next": q_queue_next,
    "queue_head": q_queue_head,
    "finalized_skus": q_finalized_skus,
    "queue_shortfall": q_queue_shortfall,
    "queue_shortfall_whole": q_queue_shortfall_whole,
    "final_key_index": q_final_key_index,
    "queue_next_indexed": q_queue_next_indexed,
    "retryable_skus": q_retryable_skus,
    "effective_time": q_effective_time,
    "run_last_seen": q_run_last_seen,
    "latest_run": q_latest_run,
    "run_facts": q_run_facts,
    "latest_run_recorded": q_latest_run_recorded,
    "status_frequency_recorded": q_status_frequency_recorded,
    "run_summary": q_run_summary,
    "latest_run_summary": q_latest_run_summary,
    "run_severity": q_run_severity,
    "report_metrics": q_report_metrics,
    "run_header": q_run_header,
    "status_frequency": q_status_frequency,
    "critical_skus": q_critical_skus,
    "critical_alert": q_critical_alert,
    "slug_normalize": q_slug_normalize,
    "slug_gate": q_slug_gate,
    "catalog_lookup": q_catalog_lookup,
    "catalog_lookup_pruned": q_catalog_lookup_pruned,
    "slug_collisions": q_slug_collisions,
    "update_outcome": q_update_outcome,
    "redirect_plan": q_redirect_plan,
    "redirect_outcome": q_redirect_outcome,
    "wrongful_redirects": q_wrongful_redirects,
}




# --- correction run (whole queue, replayed with the outcome tables) -----------------

RUN_ID = "exec-2024-02-01"
RUN_TS = dt.datetime(2024, 2, 1, 3, 0, 0)


def snapshot_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Catalogue, registry and outcome snapshots, written once.

    In production these are stored tables; here they are derived from the
    generated data and written to the checkpoint folder, so the correction
    plans read them like tables instead of re-deriving them.
    """
    cat = materialise(fx.catalog(spark, d), "catalog")
    return dict(
        catalog=cat,
        registry=materialise(fx.redirects(cat), "registry"),
        put=materialise(fx.put_outcome(cat), "put"),
        redirect_out=materialise(fx.redirect_outcome(cat), "redirect_out"),
        removals=materialise(fx.removal_outcome(cat), "removals"),
    )


def plain_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The same tables as plans of their own, for a run that touches little of them."""
    cat = fx.catalog(spark, d)
    return dict(
        catalog=cat, registry=fx.redirects(cat), put=fx.put_outcome(cat), redirect_out=fx.redirect_outcome(cat),
        removals=fx.removal_outcome(cat),
    )


def correction_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return dict(
        batch=queue.queue_head(fx.queue_src(spark, d), fx.run_log(spark, d), None),
        **snapshot_inputs(spark, d),
    )


def _whole_run(spark: SparkSession, d: str, **more: DataFrame) -> DataFrame:
    rows, _ = correction.cascade(**correction_inputs(spark, d), **more)
    return correction.log_rows(rows, RUN_ID, RUN_TS, fx.latency(spark, d))


def q_slug_resolution(spark: SparkSession, d: str) -> DataFrame:
    _, decisions = correction.cascade(**correction_inputs(spark, d))
    return decisions.select("sku_id", "outcome", "houve_colisao", "product_id_conflitante", "slug_final")


def q_status_cascade(spark: SparkSession, d: str) -> DataFrame:
    rows, _ = correction.cascade(**correction_inputs(spark, d))
    return rows.select(
        F.col("sku_id").alias("sku_vtex"), "product_id", "status", "houve_colisao", "product_id_conflitante",
        "slug_final", "put_confirmado", "redirect_confirmado", "redirect_destino",
    )


def q_run_log_rows(spark: SparkSession, d: str) -> DataFrame:
    return _whole_run(spark, d)


def q_probe_failures(spark: SparkSession, d: str) -> DataFrame:
    """The whole run with reads and probes that fail, of every kind."""
    return _whole_run(spark, d, failures=materialise(fx.read_failures(spark, d), "failures"))


def q_redirect_timeline(spark: SparkSession, d: str) -> DataFrame:
    """What every probing item finds on its path, after what earlier items did there."""
    items = correction.probed_items(**correction_inputs(spark, d))
    return items.select("sku_id", "existe", "destino_antigo", "removal_failed", "observacao")


def q_correction_batch(spark: SparkSession, d: str) -> DataFrame:
    """The nightly run: next 150 SKUs, catalogue cut to what they touch."""
    return correction.run_correction(
        fx.queue_src(spark, d), fx.run_log(spark, d), execution_id=RUN_ID, latency=fx.latency(spark, d),
        batch_size=DEFAULT_BATCH_SIZE, run_ts=RUN_TS, **plain_inputs(spark, d),
    )


QUERIES.update(
    {
        "correction_batch": q_correction_batch,
        "probe_failures": q_probe_failures,
        "redirect_timeline": q_redirect_timeline,
        "slug_resolution": q_slug_resolution,
        "status_cascade": q_status_cascade,
        "run_log_rows": q_run_log_rows,
    }
)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The smoke-check query: the whole correction run as log rows."""
    return q_run_log_rows(spark, d)
