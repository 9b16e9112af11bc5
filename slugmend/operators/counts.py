"""Rows that stand for several identical rows, and their expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows per generated chunk when one row stands for many.
COPY_CHUNK = 100_000


def expand_counts(df: DataFrame, count_col: str, key_cols: list[str], chunk: int = COPY_CHUNK) -> DataFrame:
    """One output row per unit of ``count_col`` (rows with a count < 1 vanish).

    A count is cut into chunks of at most ``chunk`` rows; the chunks are
    hash-spread over tasks before they are expanded, so a key standing for
    a third of all rows is generated by many tasks, not one.
    """
    n = F.col(count_col).cast("bigint")
    chunks = df.filter(n > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / chunk).cast("bigint"))).alias("_chunk")
    ).withColumn("_cnt", F.least(F.lit(chunk).cast("bigint"), n - F.col("_chunk") * chunk))
    spread = chunks.repartition(*key_cols, "_chunk")
    return spread.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_cnt"))).alias("_copy")).drop(
        "_chunk", "_cnt", "_copy", count_col
    )
