"""Fitted models on streams: every transform is a column expression, so it needs no state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def score_stream(stream: DataFrame, models: Sequence, vec: str, prefix: str = "out") -> DataFrame:
    """Adds ``out0, out1, ...``: the output of each fitted model on a streaming frame."""
    for i, m in enumerate(models):
        stream = m.transform(stream, vec, f"{prefix}{i}")
    return stream
