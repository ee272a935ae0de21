"""Joins whose left side may hold a large share of its rows under a few keys.

Adaptive execution splits skewed partitions by their compressed bytes, which misses a hot key
whose rows are alike and compress well, and it splits none if the other side is an aggregate on
the join key. Where the rows per key are counted anyway, the few hot keys are known and their
rows are joined in place against a broadcast of just those keys; all other rows take the normal
shuffled join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is never hot with fewer rows than this: one task handles them at once.
HOT_ROWS = 100_000
# Rows of the right side for hot keys up to which they are broadcast; more are copied per salt.
BROADCAST_ROWS = 200_000


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: str) -> DataFrame | None:
    """Keys with more rows than an average shuffle partition; None if there are none.

    ``counts`` has one row per key. No more than one key per shuffle partition can qualify,
    so the result is small whatever the data.
    """
    spark = counts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = counts.agg(F.sum(rows).alias("total"), F.max(rows).alias("largest")).head()
    limit = max(HOT_ROWS, (size["total"] or 0) / partitions)
    if (size["largest"] or 0) <= limit:
        return None
    found = counts.filter(F.col(rows) > limit).select(*keys)
    return spark.createDataFrame(found.collect(), found.schema)


def _matches(left_keys: Sequence[str], right_keys: Sequence[str], null_safe: bool) -> Column:
    condition = F.lit(True)
    for l, r in zip(left_keys, right_keys):
        condition = condition & (
            F.col(l).eqNullSafe(F.col(r)) if null_safe else F.col(l) == F.col(r)
        )
    return condition


def split_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Join on differently named keys, the rows of ``hot`` keys without a shuffle.

    ``hot`` (from ``hot_keys``) has the columns ``left_keys``. The right side's rows for hot keys
    are counted: few are broadcast, more are copied to every salt, and the left rows of hot keys
    are then spread over the salts by a shuffle.
    """
    condition = _matches(left_keys, right_keys, null_safe)
    if hot is None:
        return left.join(right, condition, how)
    marks = [f"__hot_{n}" for n in range(len(left_keys))]
    few = F.broadcast(hot.toDF(*marks))
    is_hot = _matches(left_keys, marks, True)
    right_hot = right.join(few, _matches(right_keys, marks, True), "left_semi")
    left_hot = left.join(few, is_hot, "left_semi")
    if right_hot.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        in_place = left_hot.join(F.broadcast(right_hot), condition, how)
    else:
        salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = left_hot.withColumn(
            "__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
        )
        copies = right_hot.withColumn(
            "__copy_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        )
        same_salt = F.col("__salt") == F.col("__copy_salt")
        in_place = salted.join(copies, condition & same_salt, how).drop("__salt", "__copy_salt")
    shuffled = left.join(few, is_hot, "left_anti").join(right, condition, how)
    return in_place.unionByName(shuffled)
