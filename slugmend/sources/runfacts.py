"""Facts of each run beside the log: rows per status, first and last time.

Which run is the latest, and how often each status occurred, are asked of the whole log
but depend on a few rows per run. Those rows are written once a run, under
``_manifest/runs`` of the log, and answer such questions without a row of the log. Runs
are published whole and never change, so their facts stay right; runs that the list lacks
(a driver was lost between the append and the facts, or the log is older than the list)
are read from their folders, and listed runs whose folder is gone are left out. Both are
found from the names of the log's folders.

For logs partitioned by run. The driver holds one name per run.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slugmend.sources.logschema import MANIFEST, children, file_system, move_new
from slugmend.sources.runlog import effective_time, read_log

FACTS = "execution_id string, status string, n bigint, min_t timestamp, max_t timestamp"
_RUN = "execution_id="


def facts_of(log: DataFrame) -> DataFrame:
    """The facts of log rows, one row per run and status."""
    t = effective_time(log)
    return log.groupBy("execution_id", "status").agg(
        F.count(F.lit(1)).alias("n"), F.min(t).alias("min_t"), F.max(t).alias("max_t")
    )


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{MANIFEST}/runs"


def _recorded(spark: SparkSession, path: str) -> DataFrame | None:
    if not any(n.startswith("batch=") for n in children(spark, _folder(path))):
        return None
    spark.catalog.refreshByPath(_folder(path))
    kept = spark.read.schema(FACTS).parquet(_folder(path))
    # A run that two drivers recorded at the same time has its rows twice, alike.
    return kept.groupBy("execution_id", "status").agg(
        F.max("n").alias("n"), F.min("min_t").alias("min_t"), F.max("max_t").alias("max_t")
    )


def _state(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[str], list[str]]:
    """Recorded facts, the runs among them that the log has, and the runs that are not recorded."""
    runs = {unquote(n.removeprefix(_RUN)) for n in children(spark, path) if n.startswith(_RUN)}
    recorded = _recorded(spark, path)
    known = {r[0] for r in recorded.select("execution_id").distinct().collect()} if recorded is not None else set()
    return recorded, sorted(runs & known), sorted(runs - known)


def _read(spark: SparkSession, path: str, runs: list[str]) -> DataFrame:
    return facts_of(read_log(spark, path).filter(F.col("execution_id").isin(runs)))  # their folders only


def run_facts(spark: SparkSession, path: str) -> DataFrame:
    """``execution_id``, ``status``, ``n``, ``min_t``, ``max_t`` of every run of the log at ``path``.

    Reads no row of the log where every run is recorded. A log without runs has no facts.
    """
    recorded, known, missing = _state(spark, path)
    parts = [] if recorded is None or not known else [recorded.filter(F.col("execution_id").isin(known))]
    if missing:
        parts.append(_read(spark, path, missing))
    if not parts:
        return spark.createDataFrame([], FACTS)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def record_runs(spark: SparkSession, path: str) -> int:
    """Write the facts of the runs that the list lacks; returns how many those are. Can be repeated at will."""
    missing = _state(spark, path)[2]
    if not missing:
        return 0
    name = uuid.uuid4().hex
    staged = f"{_folder(path)}/_staged-{name}"
    try:
        _read(spark, path, missing).write.parquet(staged)
        move_new(spark, staged, f"{_folder(path)}/batch={name}")
    finally:
        fs, where = file_system(spark, staged)
        fs.delete(where, True)
    return len(missing)
