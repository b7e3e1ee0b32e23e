"""Mutual information of continuous features and classes from distances to nearest neighbours.

The estimator of Ross: a row's distance to its k-th neighbour of the same class, in one feature, is a
radius; the more rows of any class lie nearer than that, the less the feature tells.  Both questions
are asked of ranks.  Neighbours in a sorted column are a few ranks away, so a row looks at the distinct
values up to k ranks above and below, wherever the range partitions end; and the rows nearer than the
radius are a difference of two running counts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions.vectors import pack, scalar_column
from wideloom.operators.ranks import cumulative
from wideloom.session import cut_lineage


def digamma(x: np.ndarray) -> np.ndarray:
    """Digamma of positive numbers: shifted beyond 8, then its asymptotic series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    for _ in range(8):
        low = x < 8
        out -= np.where(low, 1 / np.where(low, x, 1), 0)
        x = x + low
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f * (1 / 240 - f / 132))))


def _digamma(c: Column) -> Column:
    return scalar_column(lambda x: digamma(x[:, 0]), pack([c]))


def neighbor_mutual_information(df: DataFrame, vec: str, label: str, k: int = 3) -> DataFrame:
    """(i, mi): mutual information in nats of each entry of the vector with the class, 0 at least.

    Rows without a class or an entry do not count for that feature, nor do classes of a single row.
    Equal values are neighbours at distance 0; nothing is drawn at random.
    """
    long = df.where(F.col(label).isNotNull()).select(F.col(label).alias("y"), F.posexplode(vec).alias("i", "x"))
    long = long.where(F.col("x").isNotNull() & ~F.isnan("x"))
    values = cumulative(long, ["i", "y"], "x", {"n": F.count("*"), "one": F.max(F.lit(1))})
    values = cut_lineage(values.select("i", "y", "x", "n", F.col("before_one").alias("rank")))
    classes = values.groupBy("i", "y").agg(F.sum("n").alias("class_n")).where("class_n > 1")
    values = cut_lineage(values.join(F.broadcast(classes), ["i", "y"]))  # a row per feature and class

    # The k-th neighbour of the own class: the distinct values k ranks around, nearest first.
    look = values.select("i", "y", F.col("x").alias("x0"), F.explode(F.sequence(F.col("rank") - k, F.col("rank") + k)).alias("rank"))
    gap = F.struct(F.abs(F.col("x") - F.col("x0")).alias("d"), F.col("x").alias("at"), F.col("n").alias("n"))
    met = look.join(values.select("i", "y", "rank", "x", "n", "class_n"), ["i", "y", "rank"])
    lists = met.groupBy("i", "y", "x0").agg(F.array_sort(F.collect_list(gap)).alias("near"), F.first("class_n").alias("class_n"),
                                            F.max(F.when(F.col("x") == F.col("x0"), F.col("n"))).alias("n"))
    want = F.least(F.lit(k), F.col("class_n") - 1).cast("bigint")
    start = F.struct(F.lit(-1).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("d"))
    step = F.aggregate("near", start, lambda s, e: F.struct(
        (s["seen"] + e["n"]).alias("seen"), F.when(s["d"].isNull() & (s["seen"] + e["n"] >= want), e["d"]).otherwise(s["d"]).alias("d")))
    found = lists.select("i", "y", "x0", "n", "class_n", want.alias("k"), "near", step["d"].alias("d"))
    # The ends of the radius, as the neighbours' own values where they lie on it.
    def end(side, other: Column) -> Column:
        at = F.transform(F.filter("near", lambda e: (e["d"] == F.col("d")) & side(e["at"])), lambda e: e["at"])
        return F.coalesce(F.get(at, F.lit(0)), other)

    low = end(lambda v: v < F.col("x0"), F.col("x0") - F.col("d"))
    high = end(lambda v: v > F.col("x0"), F.col("x0") + F.col("d"))
    found = cut_lineage(found.select("i", "x0", "n", "class_n", "k", "d", low.alias("low"), high.alias("high")))

    points = values.select("i", F.col("x").alias("v"), "n")
    asked = found.select("i", F.explode(F.array("low", "high")).alias("v"), F.lit(0).cast("bigint").alias("n"))
    running = cut_lineage(cumulative(points.unionByName(asked), ["i"], "v", {"n": F.sum("n")}))
    below = running.select("i", F.col("v").alias("low"), (F.col("before_n") + F.col("n")).alias("to_low"),
                           F.col("before_n").alias("under"))
    above = running.select("i", F.col("v").alias("high"), F.col("before_n").alias("to_high"), (F.col("before_n") + F.col("n")).alias("upto"))
    inside = F.when(F.col("d") > 0, F.col("to_high") - F.col("to_low")).otherwise(F.col("upto") - F.col("under"))
    counted = found.join(below, ["i", "low"]).join(above, ["i", "high"]).select(
        "i", "n", "class_n", "k", inside.cast("double").alias("m"))
    terms = counted.groupBy("i").agg(
        F.sum("n").cast("double").alias("rows"),
        F.sum(F.col("n") * (_digamma(F.col("k")) - _digamma(F.col("class_n")) - _digamma(F.col("m")))).alias("s"))
    return terms.select("i", F.greatest(F.lit(0.0), _digamma(F.col("rows")) + F.col("s") / F.col("rows")).alias("mi"))
