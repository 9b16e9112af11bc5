"""Driver contract and the shape of the physical plans."""

from __future__ import annotations

import os
import sys

import pytest
from data_dirs import SF_CHECK
from pyspark.sql import functions as F

import __spark_entry__ as E
from slugmend.operators import queue
from slugmend.operators.catalog import catalog_lookup
from slugmend.plans import correction
from slugmend.plans import queries as Q
from slugmend.sources import cuts
from slugmend.sources import fixtures as fx


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == list(E.entry(spark).columns)
    assert df.count() > 0


def test_queue_scan_is_pruned_and_filtered(spark):
    df = queue.queue_counts(fx.queue_src(spark, SF_CHECK), fx.run_log(spark, SF_CHECK))
    plan = _plan(df)
    # only the columns the queue needs are read; the source key filter is pushed
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    part_scans = [s for s in scans if "part.parquet" in s]
    assert part_scans and all("ReadSchema: struct<p_partkey:bigint>" in s for s in part_scans)
    assert any("PushedFilters: [IsNotNull(p_partkey)]" in s for s in part_scans)
    event_scans = [s for s in scans if "events.parquet" in s]
    assert event_scans and all("FileScan parquet [event_id" in s and ",ts" not in s for s in event_scans)


def test_alert_limit_is_applied_before_the_shuffle(spark):
    plan = _plan(Q.q_critical_alert(spark, SF_CHECK))
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cross_products(spark, name, monkeypatch):
    """Neither in the query's own plan nor in any plan that it cuts off on the way."""
    seen = []
    whole = cuts.materialise
    watched = lambda df, label="cut": seen.append(_plan(df)) or whole(df, label)
    for module in [m for n, m in sys.modules.items() if n.startswith("slugmend.") and getattr(m, "materialise", None) is whole]:
        monkeypatch.setattr(module, "materialise", watched)
    seen.append(_plan(Q.QUERIES[name](spark, "/root/testdata/sf0.001")))
    assert not any("CartesianProduct" in p or "BroadcastNestedLoopJoin" in p for p in seen)


def test_hot_keys_leave_no_large_partition(spark):
    """A SKU listed for a third of the queue, and lookups that all miss: the joins see one row per SKU, spread."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay apart
    try:
        _spread_misses(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _spread_misses(spark):
    n = 6000
    src = spark.range(n).selectExpr("if(id % 3 = 0, '5', cast(id as string)) as sku_id")
    log = spark.createDataFrame([("5", "ERRO_API")], "sku_vtex string, status string")
    counts = queue.queue_counts(src, log)
    assert counts.count() == counts.select("sku_id").distinct().count()
    cat = spark.createDataFrame([("-1", 1, "a", True)], "sku_id string, product_id bigint, link_id string, is_active boolean")
    missing = catalog_lookup(counts, cat).filter("erro")
    assert missing.count() == counts.count()
    per_task = missing.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task < 0.5 * counts.count()


def test_nothing_is_left_after_a_run(spark, scratch):
    inputs = Q.plain_inputs(spark, "/root/testdata/sf0.001")
    src, log = fx.queue_src(spark, "/root/testdata/sf0.001"), fx.run_log(spark, "/root/testdata/sf0.001")
    folder = cuts.checkpoint_dir(spark).removeprefix("file:")
    before, there = cuts.mark(), set(os.listdir(folder))
    rows = correction.run_correction(src, log, execution_id="e", batch_size=20, log_path=f"{scratch}/log", **inputs)
    assert rows.count() == 20 and cuts.mark() == before
    assert set(os.listdir(folder)) <= there


def test_timeline_windows_are_bucketed(spark):
    """The ordered scan over events is keyed by (path, bucket); only the
    carry-in window is keyed by path, over one aggregated row per bucket."""
    import re

    from slugmend.operators.redirects import redirect_timeline

    okey = "struct<nn:boolean,num:bigint,sku:string>"
    checks = spark.createDataFrame([], f"item_id string, okey {okey}, path_atual string")
    creates = spark.createDataFrame([], f"okey {okey}, seq int, from_path string, to_path string")
    reg = spark.createDataFrame([], "from_path string, to_path string")
    plan = _plan(redirect_timeline(checks, creates, reg, None, bucket=lambda df: df.withColumn("b", F.lit(1))))
    assert re.search(r"windowspecdefinition\(path#\d+, b#\d+L?, flag#", plan)      # events: per (path, bucket)
    assert re.search(r"windowspecdefinition\(path#\d+, b#\d+L? ASC", plan)         # carry: per path, by bucket
    assert re.search(r"Aggregate\(key[s]?=\[path#\d+, b#\d+L?\]", plan)            # ... over (path, bucket) rows
    assert not re.search(r"windowspecdefinition\(path#\d+, flag#", plan)           # never events per path alone
