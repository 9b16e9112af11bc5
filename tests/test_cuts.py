"""Tables written on the way leave no shuffle files behind."""

from __future__ import annotations

from slugmend.sources import cuts

_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    return set(env.blockManager().diskBlockManager().getAllBlocks().mkString("\n").split("\n")) - {""}


def test_shuffle_files_go_with_the_write(spark):
    before = spark.conf.get(_KEY, None)
    had = {b for b in _shuffle_files(spark) if b.startswith("shuffle_")}
    since = cuts.mark()
    table = cuts.materialise(spark.range(10_000).selectExpr("id % 100 AS k").groupBy("k").count().repartition(5, "count"), "t")
    assert {b for b in _shuffle_files(spark) if b.startswith("shuffle_")} <= had
    assert spark.conf.get(_KEY, None) == before
    again = table.join(table.withColumnRenamed("count", "c"), "k")  # tables stay readable, also twice
    assert again.count() == again.count() == 100
    cuts.release(spark, since)
