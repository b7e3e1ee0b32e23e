"""Loading, labelling, sampling, splitting and saving of wide tables."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, NumericType, StructType

from wideloom.functions.samples import hex_share, lowest
from wideloom.operators.prep import impute


@dataclass(frozen=True)
class FeatureSpec:
    """Picks feature columns by name: prefix, substring or pattern, minus a deny-list."""

    prefix: str | None = None
    contains: str | None = None
    pattern: str | None = None
    exclude: tuple[str, ...] = ()
    numeric_only: bool = True

    def resolve(self, schema: StructType) -> list[str]:
        out = []
        for f in schema.fields:
            if f.name in self.exclude or (self.numeric_only and not isinstance(f.dataType, NumericType)):
                continue
            if self.prefix is not None and not f.name.startswith(self.prefix):
                continue
            if self.contains is not None and self.contains not in f.name:
                continue
            if self.pattern is not None and not re.search(self.pattern, f.name):
                continue
            out.append(f.name)
        if not out:
            raise ValueError("no feature column left")
        return out


def load_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet by suffix, else CSV with a header (schema inferred unless given)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def labelled_table(df: DataFrame, label: str, mapping: dict, spec: FeatureSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric features plus ``label`` mapped to the given integers; other columns go."""
    if label not in df.columns:
        raise ValueError(f"label column {label!r} is missing")
    features = [c for c in spec.resolve(df.schema) if c != label and c not in keep]
    code = F.lit(None).cast("int")
    for value, number in mapping.items():
        code = F.when(F.col(label) == F.lit(value), F.lit(int(number))).otherwise(code)
    return df.select(*keep, *features, code.alias("label"))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and percentage per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(label, "rows", (100.0 * F.col("rows") / total).alias("percent"))


def coerced_table(df: DataFrame, label: str, exclude: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Everything but a deny-list as double (unparsable values become null), then nulls
    take the column mean."""
    features = [f.name for f in df.schema.fields if f.name not in {label, *exclude, *keep}]
    text = df.select(*keep, F.col(label), *[F.col(c).cast("string").try_cast("double").alias(c) for c in features])
    fill = impute(text, features, "mean")
    return fill.transform(text).select(*keep, F.col(label), *features)


def encode_labels(df: DataFrame, label: str, out: str = "code", max_classes: int = 100_000) -> DataFrame:
    """Sorted distinct labels -> 0..k-1."""
    distinct = df.select(label).where(F.col(label).isNotNull()).distinct()
    values = sorted(r[0] for r in distinct.limit(max_classes + 1).collect())
    if len(values) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label!r}: not a label column")
    codes = df.sparkSession.createDataFrame(
        [(v, i) for i, v in enumerate(values)],
        StructType([df.schema[label]]).add(out, IntegerType()))
    return df.join(F.broadcast(codes), label, "left")


def fixed_sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if fewer) without replacement: the lowest by hashed key."""
    code = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))
    return lowest(df, hex_share(code), [code, *key], n)


HASH_RANGE = 2_147_483_647


def hash_code(key: str) -> Column:
    """Portable integer hash of a bigint key, below HASH_RANGE, that any SQL engine can repeat."""
    return F.pmod(F.pmod(F.col(key).cast("bigint"), F.lit(1_000_000_007)) * 48_271 + 12_345, F.lit(HASH_RANGE))


def fraction_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """The rows whose scrambled hash lies in the first ``fraction`` of its range."""
    # A second multiplication: neighbouring keys are 48,271 apart after the first.
    code = F.pmod(hash_code(key) * 69_621 + 7, F.lit(HASH_RANGE))
    return df.where(code < F.lit(fraction * HASH_RANGE))


def stratified_split(df: DataFrame, key: str, label: str, classes: Sequence, train: float = 0.7) -> DataFrame:
    """Adds ``split``: per class, the first ``round(train * rows)`` rows in MD5 order of
    the key form the training part.

    The cut is found without ordering a class in one task: the order code of the wanted
    rank is selected by narrowing on code prefixes.
    """
    coded = df.withColumn("order_code", F.md5(F.col(key).cast("string")))
    sizes = {r[0]: r[1] for r in coded.groupBy(label).count().collect()} if classes is None else {
        r[0]: r[1] for r in coded.where(F.col(label).isin(*classes)).groupBy(label).count().collect()}
    wanted = {c: int(train * n + 0.5) for c, n in sizes.items()}
    cut = _code_at_rank(coded, label, "order_code", wanted)
    is_train = F.lit(False)
    for c, code in cut.items():
        if code is not None:
            is_train = is_train | ((F.col(label) == F.lit(c)) & (F.col("order_code") <= F.lit(code)))
    return coded.withColumn("split", F.when(is_train, "train").otherwise("test")).drop("order_code")


def _code_at_rank(df: DataFrame, label: str, code: str, wanted: dict, step: int = 3) -> dict:
    """The ``wanted[c]``-th smallest code per class, by counting codes per growing prefix."""
    prefix = {c: "" for c, w in wanted.items() if w > 0}
    left = {c: wanted[c] for c in prefix}
    size = 0
    while prefix and size < 32:
        size = min(32, size + step)
        keep = F.lit(False)
        for c, p in prefix.items():
            keep = keep | ((F.col(label) == F.lit(c)) & F.col(code).startswith(p))
        rows = df.where(keep).groupBy(label, F.substring(code, 1, size).alias("p")).count().collect()
        seen: dict = {}
        for r in rows:
            seen.setdefault(r[0], []).append((r[1], r[2]))
        singles = True
        for c in prefix:
            for p, n in sorted(seen[c]):
                if left[c] <= n:
                    prefix[c] = p
                    singles &= left[c] == n
                    break
                left[c] -= n
        if singles:  # every cut falls at the end of a prefix
            return {c: prefix.get(c, "").ljust(32, "f") if c in prefix else None for c in wanted}
    return {c: prefix.get(c) for c in wanted}


def save_table(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write, then read back what was written."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.parquet(path)
        return df.sparkSession.read.parquet(path)
    if fmt == "csv":
        writer.option("header", True).csv(path)
        return df.sparkSession.read.option("header", True).schema(df.schema).csv(path)
    raise ValueError(f"unknown format {fmt!r}")


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], force: bool = False) -> DataFrame:
    """Read the processed table if a finished one exists, else compute and save it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not force and fs.exists(hadoop):
        return spark.read.parquet(path)
    return save_table(build(), path)
