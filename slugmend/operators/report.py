"""Run report: latest run, per-run summary, severity, metric rows, alerts.

Every summary is one ``agg`` per run (partial aggregation before the
shuffle), instead of separate count / aggregate / collect jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slugmend.functions.text import elapsed_seconds, format_elapsed, format_run_ts
from slugmend.schemas import (
    ALERT_LIST_LIMIT,
    BADGE_CLEAN,
    BADGE_CRITICAL,
    BADGE_RETRY,
    ERRO_REDIRECT,
    REPORT_METRICS,
    SEVERITY_CLEAN,
    SEVERITY_CRITICAL,
    SEVERITY_RETRY,
    STATUS_COUNTS,
    SUBJECT_CRITICAL,
    SUBJECT_OK,
)
from slugmend.sources.runlog import effective_time


def _optional(log: DataFrame, name: str, dtype: str):
    """A column that older logs may lack: typed null when absent."""
    return F.col(name) if name in log.columns else F.lit(None).cast(dtype)


def with_effective_time(log: DataFrame) -> DataFrame:
    """Add ``effective_ts``: legacy time column if present and set, else ``timestamp``."""
    return log.withColumn("effective_ts", effective_time(log))


def run_last_seen(log: DataFrame) -> DataFrame:
    """``(execution_id, max_t)`` per run."""
    return log.groupBy("execution_id").agg(F.max(effective_time(log)).alias("max_t"))


def latest_run(log: DataFrame) -> DataFrame:
    """The run with the latest time (runs without any time sort last)."""
    return _latest(run_last_seen(log))


def _latest(last_seen: DataFrame) -> DataFrame:
    return last_seen.orderBy(F.col("max_t").desc_nulls_last(), F.col("execution_id").asc()).limit(1)


def latest_recorded_run(facts: DataFrame) -> DataFrame:
    """:func:`latest_run` from the facts of runs (``sources.runfacts``)."""
    return _latest(facts.groupBy("execution_id").agg(F.max("max_t").alias("max_t")))


def run_summaries(log: DataFrame) -> DataFrame:
    """One summary row per run (see :func:`_timed_summaries`)."""
    return _timed_summaries(log).drop("ultimo_ts")


def _timed_summaries(log: DataFrame) -> DataFrame:
    """One summary row per run, with its last time.

    Counts per status, collisions (null is not a collision), mean latency
    (0 when unknown), first/last time, elapsed whole seconds and the last
    time as text.
    """
    t = effective_time(log)
    lat = _optional(log, "tempo_processamento_ms", "int")
    collided = _optional(log, "houve_colisao", "boolean")
    counts = [F.count_if(F.col("status") == s).alias(name) for name, s in STATUS_COUNTS]
    agg = log.groupBy("execution_id").agg(
        F.count(F.lit(1)).alias("total"),
        *counts,
        F.count_if(collided).alias("total_colisoes"),
        F.sum(lat.cast("bigint")).alias("_lat_sum"),
        F.count(lat).alias("_lat_n"),
        F.min(t).alias("primeiro_ts"),
        F.max(t).alias("ultimo_ts"),
    )
    return agg.select(
        "execution_id",
        "total",
        *[name for name, _ in STATUS_COUNTS],
        "total_colisoes",
        F.when(F.col("_lat_n") > 0, F.col("_lat_sum").cast("double") / F.col("_lat_n"))
        .otherwise(F.lit(0.0))
        .alias("tempo_medio_ms"),
        elapsed_seconds(F.col("primeiro_ts"), F.col("ultimo_ts")).alias("elapsed_sec"),
        format_run_ts(F.col("ultimo_ts")).alias("run_ts"),
        "ultimo_ts",
    )


def latest_run_summary(log: DataFrame) -> DataFrame:
    """Summary of the latest run only: one pass over the log, then the top row of the summaries."""
    order = (F.col("ultimo_ts").desc_nulls_last(), F.col("execution_id").asc())
    return _timed_summaries(log).orderBy(*order).limit(1).drop("ultimo_ts")


def run_severity(summaries: DataFrame) -> DataFrame:
    """Critical when a redirect failed; retry pending on other errors; else clean."""
    critical = F.col("erro_redirect") > 0
    retry = (F.col("erro_put") > 0) | (F.col("erro_api") > 0) | (F.col("erro_colisao") > 0)
    return summaries.select(
        "execution_id",
        F.when(critical, SEVERITY_CRITICAL).when(retry, SEVERITY_RETRY).otherwise(SEVERITY_CLEAN).alias("severity"),
        F.when(critical, BADGE_CRITICAL).when(retry, BADGE_RETRY).otherwise(BADGE_CLEAN).alias("badge"),
        F.when(critical, SUBJECT_CRITICAL).otherwise(SUBJECT_OK).alias("subject_prefix"),
    )


def report_metrics(summaries: DataFrame) -> DataFrame:
    """Nine ordered ``(ordem, metrica, valor, alerta)`` rows per run."""
    rows = [
        F.struct(
            F.lit(order).alias("ordem"),
            F.lit(label).alias("metrica"),
            F.col(col).cast("bigint").alias("valor"),
            ((F.col(col) > 0) if alert else F.lit(False)).alias("alerta"),
        )
        for order, label, col, alert in REPORT_METRICS
    ]
    return summaries.select("execution_id", F.inline(F.array(*rows)))


def run_header(summaries: DataFrame) -> DataFrame:
    """Report header fields: duration text, last time text, ``sucesso/total``."""
    return summaries.select(
        "execution_id",
        format_elapsed(F.col("elapsed_sec")).alias("duracao"),
        "run_ts",
        F.concat_ws("/", F.col("sucesso").cast("string"), F.col("total").cast("string")).alias("placar"),
    )


def status_frequency(log: DataFrame) -> DataFrame:
    """``(execution_id, status, n, ordem)``: counts per status, ranked n desc, then status.

    The rank window runs over the aggregated rows (at most one per status
    and run), so its partitions are bounded however large a run is.
    """
    return _ranked(log.groupBy("execution_id", "status").agg(F.count(F.lit(1)).alias("n")))


def recorded_status_frequency(facts: DataFrame) -> DataFrame:
    """:func:`status_frequency` from the facts of runs (``sources.runfacts``)."""
    return _ranked(facts.select("execution_id", "status", "n"))


def _ranked(counts: DataFrame) -> DataFrame:
    w = Window.partitionBy("execution_id").orderBy(F.col("n").desc(), F.col("status").asc_nulls_last())
    return counts.withColumn("ordem", F.row_number().over(w).cast("bigint"))


def critical_skus(log: DataFrame) -> DataFrame:
    """SKUs whose slug changed but whose redirect failed, with product and message (manual action)."""
    return log.filter(F.col("status") == ERRO_REDIRECT).select(
        "execution_id", "sku_vtex",
        _optional(log, "product_id", "bigint").alias("product_id"),
        _optional(log, "mensagem_erro", "string").alias("mensagem_erro"),
    )


def critical_alert(log: DataFrame, limit: int = ALERT_LIST_LIMIT) -> DataFrame:
    """Per run with failures: count, the first ``limit`` SKUs joined, ``...`` if more.

    The ``row_number() <= limit`` filter becomes a per-partition group limit
    before the shuffle, so no run's full list is ever gathered in one task.
    """
    crit = critical_skus(log)
    counts = crit.groupBy("execution_id").agg(F.count(F.lit(1)).alias("n_criticos"))
    w = Window.partitionBy("execution_id").orderBy(F.col("sku_vtex").asc_nulls_last())
    head = (
        crit.withColumn("_rn", F.row_number().over(w))
        .filter(F.col("_rn") <= limit)
        .groupBy("execution_id")
        .agg(F.array_join(F.array_sort(F.collect_list("sku_vtex")), ", ").alias("skus_lista"))
    )
    return counts.join(head, "execution_id").select(
        "execution_id",
        "n_criticos",
        "skus_lista",
        F.when(F.col("n_criticos") > limit, F.lit("...")).otherwise(F.lit("")).alias("sufixo"),
    )
