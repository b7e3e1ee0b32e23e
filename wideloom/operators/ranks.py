"""Ranks and cumulative counts over a whole table without a single-task window.

Rows are first reduced to distinct values with counts, so a value held by a third of all
rows becomes one row.  Approximate quantiles of the distinct values then cut every feature
into buckets of similar size; running totals inside a bucket plus the totals of the buckets
before it give the same result as one global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wideloom.session import cores, cut_lineage


def cumulative(
    df: DataFrame, keys: Sequence[str], value: str, counts: dict[str, Column], buckets: int | None = None
) -> DataFrame:
    """Per (keys, value): each aggregate in ``counts`` and its total over smaller values.

    Adds ``<name>`` and ``before_<name>``.  ``counts`` values are aggregate columns.
    """
    keys = list(keys)
    distinct = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        *[e.alias(n) for n, e in counts.items()])
    # Read several times below: written once, so the input is scanned and shuffled once.
    distinct = cut_lineage(distinct)
    buckets = buckets or max(8, 2 * cores(df.sparkSession))
    cuts = [i / buckets for i in range(1, buckets)]
    bounds = distinct.groupBy(*keys).agg(F.percentile_approx(value, cuts, 1000).alias("bounds"))
    # One array of cuts per key, and keys are feature names or runs: small by construction.
    joined = distinct.join(F.broadcast(bounds), keys) if keys else distinct.withColumn("bounds", bounds.scalar())
    cut = joined.withColumn(
        "bucket", F.size(F.filter("bounds", lambda b: b < F.col(value)))).drop("bounds")
    totals = cut.groupBy(*keys, "bucket").agg(*[F.sum(n).alias(f"sum_{n}") for n in counts])
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "bucket", *[
        F.coalesce(F.sum(f"sum_{n}").over(earlier), F.lit(0)).alias(f"off_{n}") for n in counts])
    inside = Window.partitionBy(*keys, "bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    out = cut.join(F.broadcast(offsets), [*keys, "bucket"])
    return out.select(*keys, value, *counts, *[
        (F.coalesce(F.sum(n).over(inside), F.lit(0)) + F.col(f"off_{n}")).alias(f"before_{n}")
        for n in counts])


def melt(df: DataFrame, features: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Wide -> long ``(keep..., feature, value)``."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    long = df.select(*keep, pairs.alias("fv"))
    return long.select(*long.columns[:-1], "fv.feature", "fv.value")
