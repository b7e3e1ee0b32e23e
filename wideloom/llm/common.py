"""Helpers shared by the text operators: stored intermediates, streamed groups, keys and hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wideloom.session import scratch_path, ship_package

BROADCAST_ROWS = 100_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


ARROW_ROWS = 512


def prepared(spark: SparkSession) -> SparkSession:
    """The session, with this package on its executors.

    Texts are long: unless the session has chosen a size of its own, Arrow batches get fewer rows
    than Spark's 10,000, so that Python workers hold a few MB of text at a time.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(ARROW_ROWS))
    return ship_package(spark)


def stored(df: DataFrame, name: str = "llm") -> DataFrame:
    """Write to the shared folder and read back: computed once, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint, only after counting that ``df`` has at most ``limit`` rows.

    Beyond it the join shuffles both sides, with the same rows as its result.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def whole_text(text: str | Column = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def fold(key: str | Column, folds: int = 5) -> Column:
    """crc32 of the key written as text, modulo ``folds`` (null: that of an empty text)."""
    c = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.encode(F.coalesce(c.cast("string"), F.lit("")), "UTF-8")) % folds


def streamed_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """(key, slices) per run of equal keys of a partition sorted by ``key``.

    Only the rows of the current key are held, however many Arrow batches they span.
    """
    held_key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_pylist()
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and held_key != keys[start]:
                yield held_key, held
                held = []
            held_key = keys[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield held_key, held


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of 64-bit hashes (splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _grown(n: int) -> None:
    have = len(_powers["up"])
    if have < n:
        size = max(n, 2 * have, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)


class SubstringHashes:
    """64-bit polynomial hashes of any substrings of one byte string, each in constant time."""

    def __init__(self, data: bytes, seed: int = 0):
        n = len(data)
        _grown(n + 1)
        codes = _BYTE_CODES if not seed else mix(_BYTE_CODES + np.uint64(seed))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[np.frombuffer(data, np.uint8)] * _powers["up"][:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * _powers["down"][start])

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all substrings of ``length`` bytes, by start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * _powers["down"][:n])


def run_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of every ``length`` consecutive 64-bit codes, each in constant time."""
    n = len(codes)
    if n < length:
        return np.zeros(0, np.uint64)
    _grown(n + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _powers["up"][:n], dtype=np.uint64)])
    return mix((sums[length:] - sums[:n - length + 1]) * _powers["down"][:n - length + 1])


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
