"""The run log: explicit schema on write, schema evolution on read.

The log is an append-only table. Parquet paths are the default format
(Delta is used when its package is on the classpath and asked for).
Appending a batch with an extra column works because the log's columns are
listed beside it (``sources.logschema``) and readers take them from there; logs
that have no list yet are read by merging the Parquet footers (``mergeSchema``).
Appending to a catalogue table with a changed schema does not work, so the
writer targets paths.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slugmend.schemas import LEGACY_TIME_COLUMN, LOG_SCHEMA, NON_NULL_LOG_COLUMNS
from slugmend.sources.logschema import known_schema, move_new, record_schema


def to_log_schema(df: DataFrame) -> DataFrame:
    """Cast to the log schema; missing optional columns become typed nulls.

    Columns beyond the schema are kept at the end (they evolve the log).
    A column that is null in every row still gets its declared type.
    """
    present = set(df.columns)
    cols: list[Column] = []
    for field in LOG_SCHEMA.fields:
        if field.name in present:
            cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
        elif field.nullable:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"required log column missing: {field.name}")
    extra = [F.col(c) for c in df.columns if c not in set(LOG_SCHEMA.fieldNames())]
    return df.select(*cols, *extra)


def null_violations(df: DataFrame) -> DataFrame:
    """One row per required column with its count of nulls (a single pass)."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in NON_NULL_LOG_COLUMNS]
    return df.agg(*aggs)


class RunAlreadyLogged(ValueError):
    """The log already holds rows of the run that is to be appended."""


def _has_run(spark: SparkSession, path: str, fmt: str, execution_id: str) -> bool:
    """Whether the log at ``path`` holds rows of the run (the filter reaches the scan)."""
    try:
        existing = read_log(spark, path, fmt)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False  # no log yet
    return not existing.filter(F.col("execution_id") == execution_id).select("execution_id").isEmpty()


def append_log(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = ("execution_id",),
    skip_empty: bool = True,
    execution_id: str | None = None,
) -> bool:
    """Append rows to the log at ``path``; returns whether anything was written.

    ``skip_empty`` is the empty-batch guard (no write for an empty batch);
    it costs one short job that stops at the first row. Rows with a null in a
    required column raise ``ValueError`` before anything is written. With
    ``execution_id``, a run that the log already has (in part or whole) raises
    :class:`RunAlreadyLogged`: nothing is dropped in silence, and a retry
    cannot duplicate rows. The log is partitioned by run, so a report reads its
    run only. In that layout the run's folder is written aside and renamed into
    place, which fails if it is there: of drivers that append under one run id at
    the same time exactly one succeeds, and none leaves a part of a run.
    """
    out = to_log_schema(df)
    if skip_empty and out.isEmpty():
        return False
    nulls = {c: n for c, n in null_violations(out).first().asDict().items() if n}
    if nulls:
        raise ValueError(f"nulls in required log columns: {nulls}")
    if execution_id is not None and _has_run(df.sparkSession, path, fmt, execution_id):
        raise RunAlreadyLogged(f"the log at {path} already has rows of run {execution_id}")
    if fmt == "parquet":
        record_schema(df.sparkSession, path, out.schema)
    writer = out.write.mode("append").option("mergeSchema", "true").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if execution_id is None or fmt != "parquet" or tuple(partition_by) != ("execution_id",):
        writer.save(path)
        return True
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"  # readers pass over such names
    writer.save(staged)
    publish_run(df.sparkSession, staged, path)
    return True


def publish_run(spark: SparkSession, staged: str, path: str) -> None:
    """Move the one run folder below ``staged`` into the log, in one step; raises if the log has the run."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    source, target = hadoop.Path(staged), hadoop.Path(path)
    fs = source.getFileSystem(conf)
    try:
        runs = [f.getPath() for f in fs.listStatus(source) if f.isDirectory()]
        if len(runs) > 1:
            raise ValueError(f"rows of {len(runs)} runs in one append")
        for run in runs:
            where = hadoop.Path(target, run.getName())
            if not move_new(spark, run.toString(), where.toString()):
                raise RunAlreadyLogged(f"the log at {path} already has {run.getName()}")
    finally:
        fs.delete(source, True)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Fresh read of the log (stale file listings dropped), log columns first.

    The columns come from the list beside the log, without opening its files; from the
    footers of all files where there is no list.
    Run ids that are partition folders are text, whatever they look like.
    """
    spark.catalog.refreshByPath(path)
    columns = known_schema(spark, path) if fmt == "parquet" else None
    reader = spark.read.format(fmt)
    log = (reader.option("mergeSchema", "true") if columns is None else reader.schema(columns)).load(path)
    first = [c for c in LOG_SCHEMA.fieldNames() if c in log.columns]
    log = log.select(*first, *(c for c in log.columns if c not in first))
    return log.withColumn("execution_id", F.col("execution_id").cast("string")) if "execution_id" in first else log


def effective_time(df: DataFrame) -> Column:
    """Time of a log row: the legacy column when present and set, else ``timestamp``.

    Decided on the schema at plan-build time, so old and new logs both work.
    """
    if LEGACY_TIME_COLUMN in df.columns:
        return F.coalesce(F.col(LEGACY_TIME_COLUMN), F.col("timestamp"))
    return F.col("timestamp")
