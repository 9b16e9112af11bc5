"""Index of final SKUs: the distinct keys of a log's final rows, in hash buckets.

The nightly queue asks only which SKUs are final. The index answers that without
reading the log: a Parquet table bucketed by SKU beside it, to which each append adds
the run's new final SKUs. A join with it by SKU moves nothing of the index, since its
buckets are the join's partitions. Merging is idempotent, so an index that missed a
run (the driver was lost between append and merge) is mended by merging the whole log.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from slugmend.operators.queue import finalized_skus
from slugmend.schemas import FINAL_STATUSES

BUCKETS = 32


def _name(path: str) -> str:
    return f"slugmend_final_keys_{hashlib.sha256(path.encode()).hexdigest()[:16]}"


def final_keys(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    """The index at ``path`` as ``(sku_vtex)``; created empty where there is none.

    ``buckets`` is the layout of the files and must stay what it was at first. The session's
    catalogue holds the table's layout, the files hold everything else.
    """
    name = _name(path)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (sku_vtex STRING) USING parquet "
        f"CLUSTERED BY (sku_vtex) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def merge_final_keys(
    rows: DataFrame, path: str, final_statuses: Sequence[str] = FINAL_STATUSES, buckets: int = BUCKETS
) -> None:
    """Add the final SKUs of ``rows`` (log rows: one run, or the whole log) that the index lacks."""
    spark = rows.sparkSession
    known = final_keys(spark, path, buckets)
    new = finalized_skus(rows, final_statuses).select("sku_vtex").filter("sku_vtex is not null").distinct()
    name = _name(path)
    new.join(known, "sku_vtex", "left_anti").repartition(buckets, "sku_vtex").write.mode("append").insertInto(name)
    spark.catalog.refreshTable(name)
