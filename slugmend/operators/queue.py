"""Queue selection: which SKUs the next correction run treats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from slugmend.functions.slug import numeric_order_key
from slugmend.operators.counts import expand_counts
from slugmend.schemas import ERRO_REDIRECT, FINAL_STATUSES
from slugmend.sources.cuts import materialise

#: Bins of the first histogram for each power of two of the SKU's number, and of each further one.
BINS_A_POWER, FINE_BINS = 64, 1024
#: SKUs of the bin in which the head ends, which are sorted in one task.
BIN_ROWS = 50_000


def queue_order(sku: str = "sku_id") -> list[Column]:
    """Processing order: numeric SKU value, then the SKU text.

    The source table has no order of its own, so one is imposed to make
    "the next N" well defined.
    """
    return [numeric_order_key(sku).asc_nulls_last(), F.col(sku).asc()]


def finalized_skus(log: DataFrame, final_statuses: Sequence[str] = FINAL_STATUSES) -> DataFrame:
    """Log rows whose status makes their SKU final ``(sku_vtex, status)``."""
    return log.filter(F.col("status").isin(list(final_statuses))).select(
        F.col("sku_vtex").cast("string").alias("sku_vtex"), "status"
    )


def queue_counts(
    src: DataFrame,
    log: DataFrame,
    sku_col: str = "sku_id",
    final_statuses: Sequence[str] = FINAL_STATUSES,
    final_keys: DataFrame | None = None,
) -> DataFrame:
    """``(sku_id, n_copies)`` of the non-null source SKUs without a final log row.

    Listings are counted per SKU and final rows are de-duplicated (both map-side
    first), so the left anti join has one row per SKU on either side and no hot
    key, however often a SKU is listed or logged. Keys are compared as strings.
    ``final_keys``, the index of :mod:`slugmend.sources.finalkeys`, stands for the log's
    final rows: it has them distinct and in buckets, so the log is neither read nor shuffled.
    """
    done = finalized_skus(log, final_statuses).select("sku_vtex").distinct() if final_keys is None else final_keys
    done = done.select("sku_vtex")
    listed = (
        src.select(F.col(sku_col).cast("string").alias("sku_id"))
        .filter(F.col("sku_id").isNotNull())
        .groupBy("sku_id")
        .agg(F.count(F.lit(1)).alias("n_copies"))
    )
    return listed.join(done, listed["sku_id"] == done["sku_vtex"], "left_anti")


def queue_candidates(
    src: DataFrame,
    log: DataFrame,
    sku_col: str = "sku_id",
    final_statuses: Sequence[str] = FINAL_STATUSES,
) -> DataFrame:
    """One row per listing of a SKU without a final log row (see :func:`queue_counts`)."""
    return expand_counts(queue_counts(src, log, sku_col, final_statuses), "n_copies", ["sku_id"])


def _coarse_bin(key: Column) -> Column:
    """A bin of a whole number that never falls as the number grows, ``BINS_A_POWER`` for each power of two."""
    size = F.floor(F.log2(F.abs(key.cast("double")) + 2) * BINS_A_POWER).cast("bigint")
    return F.when(key < 0, -size).otherwise(size)


def _bin_at(rows: DataFrame, bin_: Column, need: int) -> tuple[Row, int] | None:
    """The bin in which the ``need``-th listing lies, and the listings before it; null is the last bin.

    One row per bin comes to the driver, at most a few thousand.
    """
    key = numeric_order_key("sku_id")
    found = (
        rows.groupBy(bin_.alias("bin"))
        .agg(
            F.sum("n_copies").alias("n"), F.count(F.lit(1)).alias("rows"),
            F.min(key).alias("low"), F.max(key).alias("high"),
            F.min("sku_id").alias("first"), F.max("sku_id").alias("last"),
        )
        .collect()
    )
    before = 0
    for row in sorted(found, key=lambda r: (r["bin"] is None, r["bin"])):
        if before + row["n"] >= need:
            return row, before
        before += row["n"]
    return None


def queue_cut(counted: DataFrame, need: int, bin_rows: int) -> tuple[Column, Column, int] | None:
    """Where a head of ``need`` listings ends: rows wholly before the cut, rows of the bin it falls in, and the
    number of listings before that bin; None if the queue is shorter.

    An order statistic by histogram: counts per range of the order key, then finer ranges within the one
    that holds the rank, until it has at most ``bin_rows`` SKUs. Numbers are halved by bits, texts by their next character.
    """
    key = numeric_order_key("sku_id")
    at = _bin_at(counted, _coarse_bin(key), need)
    if at is None:
        return None
    row, before = at
    if row["bin"] is not None:
        inside = key.between(row["low"], row["high"])
        while row["rows"] > bin_rows and row["low"] < row["high"]:
            shift = 0
            while (row["high"] >> shift) - (row["low"] >> shift) >= FINE_BINS:
                shift += 1
            row, further = _bin_at(counted.filter(inside), F.shiftright(key, shift), need - before)
            before += further
            inside = key.between(row["low"], row["high"])
        return F.coalesce(key < row["low"], F.lit(False)), F.coalesce(inside, F.lit(False)), before
    inside, ahead, length = key.isNull(), key.isNotNull(), 0
    while row["rows"] > bin_rows and row["first"] < row["last"]:
        length += 1
        prefix = F.substring("sku_id", 1, length)
        row, further = _bin_at(counted.filter(inside), prefix, need - before)
        before += further
        inside, ahead = key.isNull() & (prefix == row["bin"]), key.isNotNull() | (prefix < row["bin"])
    return ahead, inside, before


def queue_head(
    src: DataFrame,
    log: DataFrame,
    batch_size: int | None,
    sku_col: str = "sku_id",
    final_statuses: Sequence[str] = FINAL_STATUSES,
    final_keys: DataFrame | None = None,
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """The next ``batch_size`` listings as ``(sku_id, n_copies)``, for any size.

    :func:`queue_cut` finds where the head ends; only the rows before it and those of the bin it falls
    in are written. In that bin (at most ``bin_rows`` SKUs, or all of one number) a running sum picks the
    SKUs, and how many copies of the last one, that are still needed. The queue is never sorted.
    """
    counted = queue_counts(src, log, sku_col, final_statuses, final_keys)
    if batch_size is None:
        return counted
    need = int(batch_size)
    cut = queue_cut(counted, need, bin_rows)
    if cut is None:  # the whole queue is shorter than the batch
        return counted
    ahead, inside, before = cut
    met = materialise(counted.filter(ahead | inside).withColumn("_edge", inside), "queue_head")
    w = Window.partitionBy("_edge").orderBy(*queue_order("sku_id")).rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        met.filter("_edge")
        .withColumn("_left", F.lit(need - before) - (F.sum("n_copies").over(w) - F.col("n_copies")))
        .filter(F.col("_left") > 0)
        .select("sku_id", F.least(F.col("n_copies"), F.col("_left")).alias("n_copies"))
    )
    return met.filter(~F.col("_edge")).select("sku_id", "n_copies").unionByName(edge)


def queue_next(
    src: DataFrame,
    log: DataFrame,
    batch_size: int | None,
    sku_col: str = "sku_id",
    final_statuses: Sequence[str] = FINAL_STATUSES,
    final_keys: DataFrame | None = None,
) -> DataFrame:
    """The next ``batch_size`` SKUs in queue order (``None``: the whole queue), one row per listing."""
    return expand_counts(queue_head(src, log, batch_size, sku_col, final_statuses, final_keys), "n_copies", ["sku_id"])


def queue_shortfall(batch: DataFrame, batch_size: int) -> DataFrame:
    """``(n_selected, batch_size, shortfall)``: fewer SKUs than asked for."""
    return batch.agg(F.count(F.lit(1)).alias("n_selected")).select(
        "n_selected",
        F.lit(int(batch_size)).cast("bigint").alias("batch_size"),
        (F.col("n_selected") < F.lit(int(batch_size))).alias("shortfall"),
    )


def retryable_skus(log: DataFrame, final_statuses: Sequence[str] = FINAL_STATUSES) -> DataFrame:
    """Per SKU: whether it is final, how often it ran, whether it will be retried.

    Failed redirects are not final, but a retry finds the slug already fixed
    and logs a final status; such SKUs are flagged for manual action.
    """
    is_final = F.col("status").isin(list(final_statuses))
    return (
        log.filter(F.col("sku_vtex").isNotNull())
        .groupBy(F.col("sku_vtex").cast("string").alias("sku_vtex"))
        .agg(
            F.count(F.lit(1)).alias("attempts"),
            F.coalesce(F.max(is_final), F.lit(False)).alias("is_final"),
            F.count_if(F.col("status") == ERRO_REDIRECT).alias("redirect_failures"),
        )
        .select(
            "sku_vtex",
            "attempts",
            "is_final",
            (~F.col("is_final")).alias("retry_pending"),
            (F.col("redirect_failures") > 0).alias("manual_action"),
        )
    )
