"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.session import cut_lineage

MAX_ROUNDS = 60


def connected_components(edges: DataFrame, group: str = "run") -> DataFrame:
    """(group, node, root): the smallest node of each component.

    ``edges`` has (group, u, v).  Every step is a ``min`` per node (combined map-side) and
    a join of the edges with one row per node; edges end as stars around the roots.
    """
    e = _tidy(edges.select(group, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), group)
    e = cut_lineage(e)
    before = None
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(group, F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(group, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, [group, "u"]).where("v > u").select(group, F.col("v").alias("u"), F.col("m").alias("v"))
        e1 = _tidy(large, group)
        low = e1.groupBy(group, "u").agg(F.min("v").alias("m"))
        small = e1.join(low, [group, "u"])
        e = _tidy(small.select(group, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select(group, "u", F.col("m").alias("v"))), group)
        e = cut_lineage(e)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64(group, "u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(group, F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(group, F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _tidy(e: DataFrame, group: str) -> DataFrame:
    return e.where("u > v").select(group, "u", "v").distinct()
