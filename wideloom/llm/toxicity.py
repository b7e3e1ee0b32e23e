"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Fit: a bounded sample of labelled rows (``max_rows``, chosen by hashed key, so that it is the same
in every run) is dealt to ``shards`` by hash.  In each round every shard runs FTRL-proximal
(McMahan et al. 2013: per-coordinate rates, L1 and L2) over its rows from the common state; the
next state is the mean of the shards' states over the coordinates that L1 left active.  What
travels are those active coordinates only.  The final weights are sparse and go to every task.

Score: a column expression over the whole text; nothing is shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import fold, prepared, small, stored, whole_text

# ASCII bytes that separate words; all others (and so whole UTF-8 sequences) belong to them.
_TO_SPACE = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Settings:
    bits: int = 22
    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 1.0
    rounds: int = 4
    shards: int = 8
    max_rows: int = 20_000


def hashed_grams(text: str | None, bits: int) -> np.ndarray:
    """Hashed coordinates of a text, repeats included: words, pairs of neighbours, triples of
    neighbours and pairs that skip one word."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()
    if not words:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    one, two = h * _A, h * _B
    pairs = two[:-1] + one[1:]
    x = np.concatenate([one, pairs, h[:-2] * _C + pairs[1:], h[:-2] * _D + h[2:] * _C])
    x ^= x >> np.uint64(29)
    x *= _B
    x >>= np.uint64(64 - bits)
    return x.view(np.int64)


def features(text: str | None, bits: int) -> np.ndarray:
    """Sorted distinct coordinates: presence only, so a text's length does not scale them."""
    return np.unique(hashed_grams(text, bits))


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    shrunk = np.sign(z) * s.l1 - z
    return np.where(np.abs(z) <= s.l1, 0.0, shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, x))))


def _epoch(rows: list[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass of FTRL-proximal; coordinate ``2**bits`` is the unpenalised intercept."""
    bias = len(z) - 1
    for idx, y in rows:
        w = _weights(z[idx], n[idx], s)
        wb = -z[bias] / ((s.beta + math.sqrt(n[bias])) / s.alpha)
        g = _sigmoid(float(w.sum()) + wb) - y
        old = n[idx]
        new = old + g * g
        z[idx] += g - (np.sqrt(new) - np.sqrt(old)) / s.alpha * w
        n[idx] = new
        nb = n[bias] + g * g
        z[bias] += g - (math.sqrt(nb) - math.sqrt(n[bias])) / s.alpha * wb
        n[bias] = nb


@dataclass(frozen=True)
class ToxicityModel:
    index: np.ndarray  # active coordinates, sorted
    weight: np.ndarray
    bias: float
    bits: int
    rows: int

    def score(self, text: str | Column = "text") -> Column:
        """Probability of label 1 for a text column; null and empty texts get the intercept's."""
        index, weight, bias, bits = self.index, self.weight, self.bias, self.bits

        def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            dense = np.zeros(1 << bits, np.float32)
            dense[index] = weight
            for texts in parts:
                out = np.empty(len(texts))
                for k, t in enumerate(texts):
                    at = hashed_grams(t, bits)
                    at = np.unique(at[dense[at] != 0])
                    out[k] = _sigmoid(bias + float(dense[at].sum(dtype=np.float64)))
                yield pd.Series(out)

        scores.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(scores, "double")(F.col(text) if isinstance(text, str) else text)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
        settings: Settings = Settings()) -> ToxicityModel:
    """Fit on the rows of ``docs`` whose key has a non-null ``label`` in ``labels``.

    Repeated keys with the same label count once; keys with contradicting labels and null keys are
    left out; null texts are empty.  Without any labelled row every score is 0.5, and with one
    class only the intercept moves.
    """
    s = settings
    spark = prepared(docs.sparkSession)
    known = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
             .where("k is not null and y in (0, 1)").groupBy("k")
             .agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").drop("y2"))
    total = known.count()
    code = F.xxhash64("k", F.lit(17))
    if total > s.max_rows:  # the documented bound of the fitting sample
        share = int(s.max_rows / total * (1 << 32))
        known = known.where(F.pmod(code, F.lit(1 << 32)) < share)
    rows = docs.select(F.col(key).alias("k"), whole_text(text).alias("t")).join(small(known), "k")
    dealt = stored(rows.select("t", "y", F.pmod(code, F.lit(s.shards)).cast("int").alias("shard"), code.alias("o")),
                   "toxic-sample")
    dealt = dealt.repartition(s.shards, "shard").sortWithinPartitions("shard", "o")
    index, z0, n0 = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    bias, used = (0.0, 0.0), 0
    for _ in range(s.rounds):
        def shard_pass(batches, index=index, z0=z0, n0=n0, bias=bias):
            held: dict[int, list] = {}
            for b in batches:
                for t, y, shard in zip(b.column("t").to_pylist(), b.column("y").to_pylist(), b.column("shard").to_pylist()):
                    held.setdefault(shard, []).append((features(t, s.bits).astype(np.int32), y))
            for shard, rows in held.items():
                z, n = np.zeros((1 << s.bits) + 1, np.float32), np.zeros((1 << s.bits) + 1, np.float32)
                z[index], n[index] = z0, n0
                z[-1], n[-1] = bias
                _epoch(rows, z, n, s)
                on = np.flatnonzero(np.abs(z[:-1]) > s.l1)
                yield pa.RecordBatch.from_pydict(
                    {"i": [on.tobytes()], "z": [z[on].astype(float).tobytes()], "n": [n[on].astype(float).tobytes()], "bz": [float(z[-1])],
                     "bn": [float(n[-1])], "rows": [len(rows)]},
                    schema=pa.schema([("i", pa.binary()), ("z", pa.binary()), ("n", pa.binary()), ("bz", pa.float64()),
                                      ("bn", pa.float64()), ("rows", pa.int64())]))

        got = dealt.mapInArrow(shard_pass, "i binary, z binary, n binary, bz double, bn double, rows long").collect()
        if not got:
            break
        used = sum(r.rows for r in got)
        share = np.array([r.rows / used for r in got])
        every = [np.frombuffer(r.i, np.int64) for r in got]
        index = np.unique(np.concatenate(every))
        z0, n0 = np.zeros(len(index)), np.zeros(len(index))
        for r, at, part in zip(got, every, share):
            where = np.searchsorted(index, at)
            z0[where] += part * np.frombuffer(r.z)
            n0[where] += part * np.frombuffer(r.n)
        bias = (float(share @ [r.bz for r in got]), float(share @ [r.bn for r in got]))
    w = _weights(z0, n0, s)
    on = np.flatnonzero(w)
    b = -bias[0] / ((s.beta + math.sqrt(bias[1])) / s.alpha)
    return ToxicityModel(index[on], w[on].astype(np.float32), b, s.bits, used)


def held_out(key: str = "doc_id") -> Column:
    return fold(key) == 0
