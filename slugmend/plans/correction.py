"""The correction run: batch of SKUs -> one log row per listed SKU -> log append.

Inputs are snapshot tables instead of per-item calls to the catalogue
service: ``catalog`` (SKU, product, current link, active flag), the
redirect ``registry``, and for replay the outcomes of the writes (``put``
per product, ``redirect_out`` and ``removals`` per path). Without outcome
tables every write is assumed to succeed (plan mode).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import logging
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slugmend.operators import cascade as K
from slugmend.operators.queue import queue_head
from slugmend.schemas import DEFAULT_BATCH_SIZE, LOG_COLUMNS
from slugmend.sources import cuts
from slugmend.sources.cuts import materialise
from slugmend.sources.finalkeys import final_keys, merge_final_keys
from slugmend.sources.runfacts import record_runs
from slugmend.sources.runlog import append_log, read_log, to_log_schema

log = logging.getLogger("slugmend")


@contextlib.contextmanager
def phase(name: str):
    """Log the wall time of one step of the run (INFO on the ``slugmend`` logger)."""
    t0 = time.perf_counter()
    yield
    log.info("phase %s took %.2fs", name, time.perf_counter() - t0)


ROW_COLUMNS = [c for c in LOG_COLUMNS if c not in ("execution_id", "timestamp", "sku_vtex", "tempo_processamento_ms")]


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "from_path string, to_path string")


def cascade(
    batch: DataFrame,
    catalog: DataFrame,
    registry: DataFrame | None = None,
    put: DataFrame | None = None,
    redirect_out: DataFrame | None = None,
    removals: DataFrame | None = None,
    sku_col: str = "sku_id",
    timeline_buckets: int = K.TIMELINE_BUCKETS,
    failures: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run the cascade; returns (log rows without run columns, collision decisions).

    ``failures`` are reads and probes that failed: ``(kind, key, msg)`` with the
    kinds of ``schemas`` (``READ_SKU``, ``READ_PRODUCT``, ``PROBE_REDIRECT``,
    ``PROBE_SLUG``).

    Cuts (Parquet in the shared checkpoint folder): the counted batch, the
    enriched batch (read by the claims, the bucket splits and the row assembly),
    the claims, the output of every collision level, the items with their
    decisions and redirects, the redirect events and the first-copy rows; all
    are batch-sized, and a lost executor then costs one stage, not the whole
    lineage.
    """
    outcomes, decisions = _outcomes(
        batch, catalog, registry, put, redirect_out, removals, sku_col, timeline_buckets, failures
    )
    # first-copy rows feed both the rows themselves and the repeats
    first = materialise(K.first_copy_rows(outcomes), "first")
    cols = ["sku_id", *ROW_COLUMNS]
    rows = first.select(*cols).unionByName(K.repeat_rows(first).select(*cols))
    return rows, decisions


def probed_items(
    batch: DataFrame,
    catalog: DataFrame,
    registry: DataFrame | None = None,
    put: DataFrame | None = None,
    redirect_out: DataFrame | None = None,
    removals: DataFrame | None = None,
    sku_col: str = "sku_id",
    timeline_buckets: int = K.TIMELINE_BUCKETS,
    failures: DataFrame | None = None,
) -> DataFrame:
    """The items that probe their current path, with what they find (first copies)."""
    outcomes, _ = _outcomes(batch, catalog, registry, put, redirect_out, removals, sku_col, timeline_buckets, failures)
    return outcomes.filter(F.col("existe").isNotNull())


def _outcomes(
    batch: DataFrame, catalog: DataFrame, registry: DataFrame | None, put: DataFrame | None,
    redirect_out: DataFrame | None, removals: DataFrame | None, sku_col: str, timeline_buckets: int,
    failures: DataFrame | None,
) -> tuple[DataFrame, DataFrame]:
    """The steps of the cascade up to the items with all their outcomes; and the collision decisions."""
    spark = batch.sparkSession
    with phase("enrich"):
        # the run's batch, counted per SKU: selected once, read by every later step
        items = materialise(K.batch_items(batch, sku_col), "batch")
        enriched = materialise(K.enrich(items, catalog, put, failures), "enriched")
    with phase("buckets"):
        splits = K.batch_cuts(enriched, timeline_buckets)
    with phase("collisions"):
        resolved = K.resolve(enriched, catalog, failures)
        decisions = resolved.withColumnRenamed("item_id", "sku_id")
        items = K.join_decisions(enriched, decisions)
    with phase("redirects"):
        reg = registry if registry is not None else empty_registry(spark)
        outcomes = K.item_outcomes(items, reg, redirect_out, removals, K.order_buckets(splits), failures)
    return outcomes, decisions


def log_rows(
    rows: DataFrame,
    execution_id: str,
    run_ts: dt.datetime | None = None,
    latency: DataFrame | None = None,
) -> DataFrame:
    """Stamp run columns and cast to the log schema.

    ``run_ts`` is one instant for the whole run (default: now, evaluated
    once per query). Latency is only known when an outside system reports
    it (``latency``: ``sku_id, tempo_processamento_ms``); otherwise null.
    """
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    out = rows.select(
        F.lit(execution_id).alias("execution_id"),
        ts.alias("timestamp"),
        F.col("sku_id").alias("sku_vtex"),
        *ROW_COLUMNS,
        F.lit(None).cast("int").alias("tempo_processamento_ms"),
    )
    if latency is not None:
        lat = latency.select(
            F.col("sku_id").alias("sku_vtex"), F.col("tempo_processamento_ms").alias("_lat")
        ).groupBy("sku_vtex").agg(F.max("_lat").alias("_lat"))
        out = out.join(lat, "sku_vtex", "left").withColumn("tempo_processamento_ms", F.col("_lat")).drop("_lat")
    return to_log_schema(out)


def run_correction(
    source: DataFrame,
    log: DataFrame,
    catalog: DataFrame,
    execution_id: str,
    registry: DataFrame | None = None,
    put: DataFrame | None = None,
    redirect_out: DataFrame | None = None,
    removals: DataFrame | None = None,
    batch_size: int | None = DEFAULT_BATCH_SIZE,
    run_ts: dt.datetime | None = None,
    log_path: str | None = None,
    log_format: str = "parquet",
    failures: DataFrame | None = None,
    latency: DataFrame | None = None,
    final_keys_path: str | None = None,
) -> DataFrame:
    """Queue -> cascade -> log rows; appended to ``log_path`` when given.

    With ``final_keys_path`` the queue asks the index of final SKUs there instead of
    reading the log, and the run's final SKUs are merged into it after the append.

    The rows are written before this returns. Intermediate tables are deleted
    then; with ``log_path`` the returned rows are read from the log, else from
    one table in the checkpoint folder.
    """
    spark = source.sparkSession
    start = cuts.mark()
    known = final_keys(spark, final_keys_path) if final_keys_path is not None else None
    batch = queue_head(source, log, batch_size, final_keys=known)  # counted; the cascade reads n_copies
    rows, _ = cascade(batch, catalog, registry, put, redirect_out, removals, failures=failures)
    out = log_rows(rows, execution_id, run_ts, latency)
    if log_path is not None:
        out = materialise(out, "log_rows")
        append_log(out, log_path, log_format, execution_id=execution_id)
        if log_format == "parquet":
            record_runs(spark, log_path)
        if final_keys_path is not None:
            merge_final_keys(out, final_keys_path)
        cuts.release(spark, start)
        return read_log(spark, log_path, log_format).filter(F.col("execution_id") == F.lit(execution_id))
    out.write.mode("overwrite").parquet(path := cuts.new_path(spark, "run"))
    cuts.release(spark, start)
    return cuts.keep(spark, path, out.schema)
