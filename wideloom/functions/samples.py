"""Samples by hashed key: the same rows in every run, without a global sort of the table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lowest(df: DataFrame, share: Column, order: list, n: int, rows: int | None = None) -> DataFrame:
    """The first ``n`` rows by ``order``, whose leading column is a hash of the row.

    ``share`` maps that hash evenly to [0, 1): a threshold on it leaves little more than ``n`` rows
    to sort.  Should it leave too few (repeated keys share their hash), it is raised.
    """
    total = df.count() if rows is None else rows
    cut = (n + 8 * math.sqrt(n) + 16) / max(total, 1)
    while cut < 0.5:
        few = df.where(share < cut)
        if few.limit(n).count() >= n:
            return few.orderBy(*order).limit(n)
        cut *= 4
    return df.orderBy(*order).limit(n)


def long_share(code: Column) -> Column:
    """A 64-bit hash as a number in [0, 1), in the hash's order."""
    return code / F.lit(2.0 ** 64) + 0.5


def hex_share(code: Column) -> Column:
    """The same for a hash in hexadecimal digits."""
    return F.conv(F.substring(code, 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
