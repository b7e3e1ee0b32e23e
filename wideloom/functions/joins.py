"""Joins that stay balanced and only broadcast what was measured."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
HOT_SHARE = 1000  # a key is hot with more than 1/1000 of the rows; at most 1000 keys are


def measured_broadcast(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting that the side is small."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def join_groups(df: DataFrame, groups: DataFrame, key: str, weight: str, total: int, limit: int = BROADCAST_ROWS
                ) -> DataFrame:
    """Attach one row per key of ``groups`` (which holds ``weight`` = rows of that key) to
    every row of ``df``; null keys match each other.

    Few groups are broadcast.  Otherwise the hot ones, at most a thousand, are matched by
    broadcast and only rows of ordinary keys are shuffled.
    """
    right = groups.withColumnRenamed(key, "_key").drop(weight)
    if groups.limit(limit + 1).count() <= limit:
        return df.join(F.broadcast(right), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    is_hot = F.col(weight) > total / HOT_SHARE
    hot = groups.where(is_hot).withColumnRenamed(key, "_key").drop(weight)
    cold = groups.where(~is_hot).withColumnRenamed(key, "_key").drop(weight)
    hot_keys = F.broadcast(hot.select("_key"))
    match = F.col(key).eqNullSafe(F.col("_key"))
    return df.join(F.broadcast(hot), match).drop("_key").unionByName(
        df.join(hot_keys, match, "left_anti").join(cold, match).drop("_key"))
