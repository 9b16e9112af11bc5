"""The run report: which run to report, and its figures as DataFrames.

Sending the report (mail server, recipients, HTML layout) is not part of
this package; the figures it shows are: the summary row, the nine metric
rows, the severity, the header texts and the critical SKUs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slugmend.operators import report
from slugmend.sources.runfacts import run_facts
from slugmend.sources.runlog import read_log


@dataclass
class RunReport:
    execution_id: str
    summary: DataFrame      # one row (run_summaries)
    severity: DataFrame     # one row
    header: DataFrame       # one row
    metrics: DataFrame      # nine rows
    alert: DataFrame        # zero or one row
    critical: DataFrame     # every SKU needing manual action


def resolve_execution_id(log: DataFrame, execution_id: str | None = None) -> str:
    """The given run id, or the latest run in the log (one-row job).

    Raises ``ValueError`` for an empty log.
    """
    if execution_id:
        return execution_id
    row = report.latest_run(log).first()
    if row is None:
        raise ValueError("the log has no rows, so there is no run to report")
    return row["execution_id"]


def report_of_log(spark: SparkSession, path: str, execution_id: str | None = None) -> RunReport:
    """Report for one run of the log at ``path`` (partitioned by run; default: the latest).

    The latest run comes from the facts of runs, so only the reported run's folder is read.
    """
    if not execution_id:
        row = report.latest_recorded_run(run_facts(spark, path)).first()
        if row is None:
            raise ValueError("the log has no runs, so there is none to report")
        execution_id = row["execution_id"]
    return build_report(read_log(spark, path), execution_id)


def build_report(log: DataFrame, execution_id: str | None = None, check_empty: bool = True) -> RunReport:
    """Report for one run (default: the latest).

    The run filter is a literal on ``execution_id``, so it reaches the scan
    (and prunes partitions when the log is partitioned by run). The summary
    is computed once and materialised; everything else derives from it or
    from the filtered rows.
    """
    run_id = resolve_execution_id(log, execution_id)
    rows = log.filter(F.col("execution_id") == F.lit(run_id))
    # One row; cached for the derived tables (recomputed if an executor is lost).
    summary = report.run_summaries(rows).cache()
    if check_empty and summary.isEmpty():
        raise ValueError(f"the log has no rows of run {run_id}")
    return RunReport(
        execution_id=run_id,
        summary=summary,
        severity=report.run_severity(summary),
        header=report.run_header(summary),
        metrics=report.report_metrics(summary),
        alert=report.critical_alert(rows),
        critical=report.critical_skus(rows),
    )
