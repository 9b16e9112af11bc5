"""Lookups where one key holds a third of the items."""

from __future__ import annotations

import statistics
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from slugmend.operators import cascade, catalog, collisions, redirects
from slugmend.operators.lookup import heavy_keys, lookup

SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",  # small partitions stay apart
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
N = 48_000


@contextmanager
def shuffled(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _items(spark):
    return spark.range(N).selectExpr("id", "case when id % 3 = 0 then 'hot' when id % 50 = 1 then null else cast(id as string) end k")


def _right(spark):
    keys = spark.range(N).selectExpr("if(id = 0, 'hot', cast(id as string)) k", "id v")
    return keys.groupBy("k").agg(F.max("v").alias("v"))  # partitioned by its key, as in the library


def _tasks(df):
    """Rows of each task; every column is read, or the join would be left out."""
    read = F.max(F.xxhash64(*df.columns))
    return [r["n"] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), read).collect()]


def test_a_third_of_the_rows_on_one_key_is_spread(spark):
    with shuffled(spark):
        plain = _tasks(_items(spark).join(_right(spark), "k", "left"))
        spread = _tasks(lookup(_items(spark), _right(spark), "k"))
    assert max(plain) > 3 * statistics.median(plain)  # the case is one
    assert sum(spread) == N and max(spread) < 2 * statistics.median(spread)


def test_rows_are_those_of_the_plain_join(spark):
    items, right = _items(spark), _right(spark)
    got, want = lookup(items, right, "k"), items.join(right, "k", "left")
    assert got.columns == want.columns
    assert got.count() == N and got.exceptAll(want).isEmpty()


def test_heavy_keys_are_those_above_half_a_partition(spark):
    heavy = heavy_keys(_items(spark), "k", 8).first()["heavy"]
    assert list(heavy) == ["hot"] and 20 <= heavy["hot"] <= 24  # 8 slices x 8 partitions x its share


def test_no_items_and_no_right_rows(spark):
    items, right = _items(spark), _right(spark)
    assert lookup(items.limit(0), right, "k").isEmpty()
    assert lookup(items, right.filter("false"), "k").filter("v is null").count() == N


def _products(spark):
    return spark.range(N).selectExpr("id as product_id", "concat('s-', id) as link_id", "true as is_active")


def _paths(spark):
    return spark.range(N).selectExpr("concat('/s-', id, '/p') as from_path", "false as erro", "cast(null as string) as msg")


def _product_lookup(spark):
    cat = spark.range(N).selectExpr("cast(id as string) sku_id", "if(id % 3 = 0, 0, id) product_id", "concat('S-', id) link_id", "true is_active")
    return catalog.catalog_lookup(cat.select("sku_id"), cat, one_row_per_sku=True)


def _sku_lookup(spark):
    cat = spark.range(N).selectExpr("cast(id as string) sku_id", "id product_id", "concat('S-', id) link_id", "true is_active")
    return catalog.catalog_lookup(spark.range(N).selectExpr("id item", "cast(if(id % 3 = 0, 0, id) as string) sku_id"), cat)


def _slugs(spark):
    items = spark.range(N).selectExpr("id item", "id + 1 product_id", "if(id % 3 = 0, 's-0', concat('s-', id)) slug_normalizado")
    return collisions.snapshot_collisions(items, _products(spark))


def _probe(spark):
    items = spark.range(N).selectExpr("id item", "if(id % 3 = 0, 'S-0', concat('S-', id)) link_id")
    registry = _paths(spark).selectExpr("from_path", "'/x/p' to_path")
    return redirects.wrongful_redirects(items, registry, _paths(spark))


def _update(spark):
    items = spark.range(N).selectExpr("cast(id as string) sku_id", "if(id % 3 = 0, 0, id) product_id")
    return cascade.update_outcome(items, _products(spark).selectExpr("product_id", "false erro", "'' msg"))


def _attempts(spark):
    items = spark.range(N).selectExpr("id product_id", "if(id % 3 = 0, 's-0', concat('s-', id)) link_id", "concat('t-', id) slug_final")
    return redirects.redirect_outcome(items, _paths(spark))


@pytest.mark.parametrize("site", [_product_lookup, _sku_lookup, _slugs, _probe, _update, _attempts], ids=lambda f: f.__name__)
def test_every_lookup_deals_a_heavy_key(spark, site):
    """J2, J3, J4 and J7, J5, J8, J9: the heavy key is known and its items go to many tasks."""
    with shuffled(spark):
        out = site(spark)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "approx_top_k" in plan and "_lookup_salt" in plan
        tasks = _tasks(out)
    assert sum(tasks) == N and max(tasks) < 2 * statistics.median(tasks)
