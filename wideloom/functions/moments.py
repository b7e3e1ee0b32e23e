"""Per-group moments of a vector column in one native, map-side combined aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("mean", "var", "min", "max")


def class_moments(df: DataFrame, vec: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., n, mean, var, min, max): arrays per group; ``var`` is the population one.

    Whole vectors are folded inside the aggregate, so rows are never exploded into
    (rows x features) and only one summary per group and task is shuffled.
    """
    s = df.groupBy(*by).agg(Summarizer.metrics("count", "mean", "variance", "min", "max").summary(
        array_to_vector(F.col(vec))).alias("s"))
    n = F.col("s.count")
    var = F.transform(vector_to_array("s.variance"), lambda v: v * (n - 1) / n)
    return s.select(*by, n.alias("n"), vector_to_array("s.mean").alias("mean"), var.alias("var"),
                    vector_to_array("s.min").alias("min"), vector_to_array("s.max").alias("max"))


def moments_long(df: DataFrame, vec: str, by: Sequence[str] = ()) -> DataFrame:
    """The same with one row per (group, entry i)."""
    m = class_moments(df, vec, by)
    return m.select(*by, "n", F.posexplode(F.arrays_zip(*FIELDS)).alias("i", "m")).select(*by, "i", "n", "m.*")
