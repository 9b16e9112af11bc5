"""Outcome and failure tables, brought to one row per key.

An outcome history may hold several rows for a key (attempts, retries, copies).
A key counts as failed if any of its rows is, with the smallest failure text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcome_per(outcomes: DataFrame, key: str) -> DataFrame:
    """``(key, erro, msg)``: one row per key, null keys left out."""
    failed = F.coalesce(F.col("erro"), F.lit(False))
    return (
        outcomes.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(failed).alias("erro"), F.min(F.when(failed, F.col("msg"))).alias("msg"))
    )


def registry_per_path(registry: DataFrame) -> DataFrame:
    """``(from_path, to_path)``: one row per path, the smallest target."""
    return registry.filter(F.col("from_path").isNotNull()).groupBy("from_path").agg(F.min("to_path").alias("to_path"))


def failures_of(failures: DataFrame | None, kind: str, key: str, text: str, like: DataFrame) -> DataFrame:
    """``(key, text)`` of the failed reads of one kind, one row per key; without a table, no rows."""
    if failures is None:
        return like.sparkSession.createDataFrame([], f"{key} string, {text} string")
    return (
        failures.filter(F.col("kind") == kind)
        .groupBy(F.col("key").alias(key))
        .agg(F.coalesce(F.min("msg"), F.lit("None")).alias(text))
    )
