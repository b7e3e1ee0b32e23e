"""Named queries over the test tables, each with its oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wideloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ship_package(spark), lambda t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet"))

        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def rnd(c: str | Column, digits: int = 6) -> Column:
    """Rounded double without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})


LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def embeddings(table) -> DataFrame:
    return table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


# DuckDB fragments shared by several oracles.
EMB = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
EMB_LONG = f"(SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM {EMB})"


def long_sql(table: str, cols: list[str], keep: str = "") -> str:
    keep = keep + ", " if keep else ""
    return "(" + " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {table}" for c in cols) + ")"


def poly_sql(x: str, coefs) -> str:
    out = f"{float(coefs[-1])!r}::DOUBLE"
    for c in reversed(coefs[:-1]):
        out = f"({out} * {x} + {float(c)!r}::DOUBLE)"
    return out
