"""Queue selection against the whole queue in order, for batches of any size."""

from __future__ import annotations

from collections import Counter

import pytest
from data_dirs import SF_CHECK
from pyspark.sql import functions as F

from slugmend.operators import queue
from slugmend.sources import fixtures as fx


@pytest.fixture(scope="module")
def inputs(spark):
    return fx.queue_src(spark, SF_CHECK), fx.run_log(spark, SF_CHECK)


@pytest.fixture(scope="module")
def ordered(inputs):
    """The whole queue in order, computed independently on the driver (test only)."""
    src, log = inputs
    rows = [r["sku_id"] for r in queue.queue_candidates(src, log).collect()]

    def key(s):
        return (not s.isdigit(), int(s) if s.isdigit() else 0, s)

    return sorted(rows, key=key)


def _sizes(ordered):
    dup = next(i for i in range(len(ordered) - 1) if ordered[i] == ordered[i + 1])
    return [1, 37, 150, dup + 1, len(ordered) - 1, len(ordered), len(ordered) + 5]


def test_range_head_equals_ordered_prefix(spark, inputs, ordered):
    src, log = inputs
    for n in _sizes(ordered):
        head = queue.queue_head(src, log, n, bin_rows=5)
        got = Counter({r["sku_id"]: r["n_copies"] for r in head.collect()})
        assert got == Counter(ordered[:n]), n


def test_batch_expands_to_one_row_per_listing(spark, inputs, ordered):
    src, log = inputs
    n = _sizes(ordered)[3]
    got = Counter(r["sku_id"] for r in queue.queue_next(src, log, n).collect())
    assert got == Counter(ordered[:n])


def test_expand_counts_spreads_large_counts(spark):
    from slugmend.operators.counts import expand_counts

    df = spark.createDataFrame([("a", 7), ("b", 1), ("c", 0)], "k string, n bigint")
    out = expand_counts(df, "n", ["k"], chunk=3)
    assert Counter(r["k"] for r in out.collect()) == Counter({"a": 7, "b": 1})
    assert out.columns == ["k"]
    assert out.filter(F.col("k") == "a").count() == 7


def test_cascade_reads_a_counted_batch(spark):
    from data_dirs import SF_SMALL

    from slugmend.plans import correction

    src, log = fx.queue_src(spark, SF_SMALL), fx.run_log(spark, SF_SMALL)
    cat = fx.catalog(spark, SF_SMALL)
    rows_a, _ = correction.cascade(queue.queue_next(src, log, 120), cat, fx.redirects(cat), fx.put_outcome(cat))
    rows_b, _ = correction.cascade(queue.queue_head(src, log, 120), cat, fx.redirects(cat), fx.put_outcome(cat))
    a = Counter(tuple(r) for r in rows_a.collect())
    b = Counter(tuple(r) for r in rows_b.collect())
    assert a == b and sum(a.values()) == 120


def test_head_cuts_inside_a_hot_sku(spark):
    """One SKU listed 1000 times (most of the queue): the head takes part of its copies."""
    rows = [("5",)] * 1000 + [(str(i),) for i in range(1, 200)]
    src = spark.createDataFrame(rows, "sku_id string")
    log = spark.createDataFrame([("3", "SUCESSO")], "sku_vtex string, status string")
    head = {r["sku_id"]: r["n_copies"] for r in queue.queue_head(src, log, 503, bin_rows=4).collect()}
    # queue order: 1, 2, 4 (3 is final), then the 1001 copies of 5, then 6, ...
    assert head == {"1": 1, "2": 1, "4": 1, "5": 500}
    rows_out = queue.queue_next(src, log, 503).collect()
    assert len(rows_out) == 503 and sum(r["sku_id"] == "5" for r in rows_out) == 500


def test_head_with_adaptive_range_partitions(spark, inputs, ordered):
    src, log = inputs
    n = _sizes(ordered)[3]
    head = queue.queue_head(src, log, n)
    assert Counter({r["sku_id"]: r["n_copies"] for r in head.collect()}) == Counter(ordered[:n])


def test_head_of_odd_keys(spark):
    """Negative and huge numbers, several texts of one number, texts with common beginnings; every batch size."""
    import random

    rnd = random.Random(1)
    skus = [str(rnd.randrange(-50, 10**rnd.choice((1, 2, 4, 9, 18)))) for _ in range(120)]
    skus += ["7", "07", "007", "-3", str(2**63 - 1), str(-(2**63)), str(2**63)]  # the last is no bigint
    skus += ["produto-" + "abç"[i % 3] * (i % 4) + str(i % 5) for i in range(60)] + ["", "produto-", "\U0001d11e"]
    src = spark.createDataFrame([(s,) for s in skus], "sku_id string").repartition(3)
    log = spark.createDataFrame([("8", "SUCESSO")], "sku_vtex string, status string")

    def key(s):
        whole = s.lstrip("-").isdigit() and -(2**63) <= int(s) < 2**63
        return not whole, int(s) if whole else 0, s.encode()

    ordered = sorted((s for s in skus if s != "8"), key=key)
    for n in (0, 1, 7, 60, 118, 124, 131, 150, len(ordered) - 1, len(ordered), len(ordered) + 3):
        for bin_rows in (1, 10, 10**6):
            got = Counter({r["sku_id"]: r["n_copies"] for r in queue.queue_head(src, log, n, bin_rows=bin_rows).collect()})
            assert got == Counter(ordered[:n]), (n, bin_rows)


def test_head_writes_the_batch_and_one_bin(spark, monkeypatch):
    written = []
    whole = queue.materialise
    monkeypatch.setattr(queue, "materialise", lambda df, name: written.append(whole(df, name)) or written[-1])
    src = spark.range(1, 200_001).selectExpr("cast(id as string) sku_id")
    log = spark.createDataFrame([], "sku_vtex string, status string")
    head = queue.queue_head(src, log, 90_000, bin_rows=500)
    assert head.count() == 90_000 and [df.count() <= 90_000 + 500 for df in written] == [True]
    assert head.selectExpr("max(cast(sku_id as bigint))").first()[0] == 90_000


def test_final_key_index(spark, scratch):
    """Random appends: the index is what the full log says, also after a missed run, and is joined where it lies."""
    import random

    from slugmend.sources.finalkeys import final_keys, merge_final_keys

    rnd = random.Random(6)
    schema = "sku_vtex string, status string"
    log = spark.createDataFrame([], schema)
    path = f"{scratch}/finals"
    src = spark.createDataFrame([(str(i),) for i in range(60)], "sku_id string")
    for run in range(4):
        rows = [(rnd.choice((str(rnd.randrange(60)), None)), rnd.choice(("SUCESSO", "ERRO_API", "PULADO_INATIVO"))) for _ in range(25)]
        part = spark.createDataFrame(rows, schema)
        log = log.unionByName(part)
        if run != 2:
            merge_final_keys(part, path)
    merge_final_keys(log, path)  # run 2 was missed
    index = final_keys(spark, path)
    want = {r[0] for r in queue.finalized_skus(log).select("sku_vtex").distinct().collect()} - {None}
    assert sorted(r[0] for r in index.collect()) == sorted(want)
    for n in (None, 5):
        got, full = queue.queue_head(src, log, n, final_keys=index), queue.queue_head(src, log, n)
        assert sorted(got.collect()) == sorted(full.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = queue.queue_counts(src, log, final_keys=index)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert not any("Exchange" in line and "sku_vtex" in line for line in plan.splitlines())


def test_run_with_the_index_equals_run_with_the_log(spark, scratch):
    """Nightly runs one after the other: the index selects what the log selects, and grows with each run."""
    from data_dirs import SF_SMALL

    from slugmend.plans import correction
    from slugmend.plans import queries as Q
    from slugmend.sources.finalkeys import final_keys, merge_final_keys
    from slugmend.sources.runlog import append_log, read_log

    inputs = Q.plain_inputs(spark, SF_SMALL)
    src, old = fx.queue_src(spark, SF_SMALL), fx.run_log(spark, SF_SMALL)
    old = old.withColumn("timestamp", F.coalesce("timestamp", F.lit("2024-01-01").cast("timestamp")))
    path, finals = f"{scratch}/log", f"{scratch}/finals"
    append_log(old, path)
    merge_final_keys(read_log(spark, path), finals)
    for run in ("n1", "n2"):
        log = read_log(spark, path)
        want = Counter(r["sku_id"] for r in queue.queue_next(src, log, 15).collect())
        rows = correction.run_correction(
            src, log.limit(0), execution_id=run, batch_size=15, log_path=path, final_keys_path=finals, **inputs
        )  # the log given is empty: only the index can tell
        assert Counter(r["sku_vtex"] for r in rows.collect()) == want
    done = queue.finalized_skus(read_log(spark, path)).select("sku_vtex").filter("sku_vtex is not null").distinct()
    assert sorted(done.collect()) == sorted(final_keys(spark, finals).collect())
