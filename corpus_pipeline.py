"""The corpus pipeline: five stages, each one operator of ``wideloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's documents.  All stages but the last keep the columns of documents.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wideloom.llm import decontaminate, ngram_join, packing, secrets, toxicity  # noqa: E402
from wideloom.llm.common import fold, prepared, stored  # noqa: E402

TOXIC_FROM = 0.5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model, fitted on the labelled rows outside fold 0, does not reject."""
    labels = _table(prepared(spark), sf_dir, "labels").where(fold("doc_id") != 0)
    return docs.where(toxicity.fit(docs, labels).score() < TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that of the least doc_id."""
    prepared(spark)
    return ngram_join.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item is found."""
    return decontaminate.decontaminated(docs, _table(prepared(spark), sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; found secrets are replaced by a mark."""
    prepared(spark)
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows and their places in windows of 1024 tokens."""
    prepared(spark)
    return packing.packed(docs, added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# The first stage is a fitted model and the last a tokenizer, neither of which SQL can express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
