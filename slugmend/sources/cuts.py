"""Lineage cuts: intermediate tables written to the shared checkpoint folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from slugmend.session import checkpoint_dir

# Folders of this process's cuts that still exist, in the order they were made.
_made: list[str] = []

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Queries run in here delete their shuffle files when they end, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back.

    One computation of ``df`` (an RDD checkpoint computes it twice),
    columnar storage, and the read-back carries real file sizes, so AQE's
    broadcast decisions downstream rest on measured sizes. The folder is
    the one the cluster names in ``spark.checkpoint.dir``, so the table
    survives the loss of any executor. It is deleted by :func:`release`, at
    the latest when the driver's interpreter ends. The shuffle files of the
    write are deleted with its end, since nothing reads them again.
    """
    path = new_path(df.sparkSession, name)
    _made.append(path)
    with _shuffles_deleted(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/slugmend-{name}-{uuid.uuid4().hex}"


def keep(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a table written to a new path, and count it among the cuts."""
    _made.append(path)
    return spark.read.schema(schema).parquet(path)


def mark() -> int:
    """A point in time for :func:`release`."""
    return len(_made)


def made(since: int) -> list[str]:
    """The folders of the cuts made since ``since``."""
    return _made[since:]


def release(spark: SparkSession, since: int = 0, only: list[str] | None = None) -> None:
    """Delete the cuts made since ``since``, or ``only`` these of them; frames that read them are no longer usable."""
    for path in _made[since:] if only is None else [p for p in only if p in _made]:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        _made.remove(path)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _made else None
    if spark is not None and spark.sparkContext._jsc is not None:
        try:
            release(spark)
        except (PySparkException, OSError):  # the gateway is already down
            pass
