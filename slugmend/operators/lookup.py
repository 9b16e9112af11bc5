"""Joins of many items with one row per key, where a few keys hold a large share of the items.

Such a join sends all items of a key to one task, and the engine cannot split that
task: the other side is the output of an aggregation by the same key, which has no
shuffle of its own. Here the heavy keys are found by a frequent-items sketch of the
items (mergeable, of a fixed size, one aggregated row), their items are dealt over
salts in proportion to their share, and their one right row is repeated once a salt.

Everything stays in one declarative plan: the sketch is a scalar subquery, which both
sides of the join ask, so there is no job of its own and no list of keys on the driver.
Without heavy keys every salt is 0 and the right side is as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that the sketch reports, and counters it keeps; a count is off by at most items / counters.
SKETCH_KEYS, SKETCH_COUNTERS = 1000, 10_000
#: Slices that a partition's worth of a heavy key's items is cut into, so that slices which
#: meet in one task by chance leave it near the others.
SLICES = 8

_KEY, _SALT = "_lookup_key", "_lookup_salt"


def heavy_keys(items: DataFrame, key: str, partitions: int) -> DataFrame:
    """One row with ``heavy``, a map from each key that holds over half a partition's share of the
    items to its number of salts. A share below ``1 / SKETCH_COUNTERS`` is never heavy."""
    top = F.expr(f"approx_top_k({_KEY}, {SKETCH_KEYS}, {SKETCH_COUNTERS})")
    sketch = items.select(F.col(key).cast("string").alias(_KEY)).filter(F.col(_KEY).isNotNull())
    floor = max(0.5 / partitions, 1.0 / SKETCH_COUNTERS)
    return sketch.agg(top.alias("top"), F.count(F.lit(1)).alias("n")).select(
        F.map_from_entries(
            F.transform(
                F.filter("top", lambda t: t["count"] > F.col("n") * floor),
                lambda t: F.struct(
                    t["item"].alias("key"),
                    F.ceil(t["count"] * F.lit(SLICES * partitions) / F.col("n")).cast("int").alias("salts"),
                ),
            )
        ).alias("heavy")
    )


def lookup(items: DataFrame, right: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``items`` left join ``right`` on ``key``, a text column of both; ``right`` has one row per key.

    The columns are those of the join by name. Items of a heavy key, and items without a key
    (which meet nothing), are dealt by a hash of the whole row: rows that differ anywhere go
    apart, equal ones stay together. ``partitions`` is the number of tasks that the salts are
    made for, by default that of the session's shuffles.
    """
    spark = items.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(items, key, partitions).scalar()

    def salts(k: Column) -> Column:
        return F.coalesce(F.try_element_at(heavy, k), F.lit(1))

    own = F.when(F.col(key).isNull(), F.lit(SLICES * partitions)).otherwise(salts(F.col(key)))
    dealt = items.withColumn(_SALT, F.pmod(F.xxhash64(*[F.col(c) for c in items.columns]), own).cast("int"))
    copies = right.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts(F.col(key)) - 1)))
    return dealt.join(copies, [key, _SALT], "left").drop(_SALT)
