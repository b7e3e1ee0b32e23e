"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

1. One pass over the texts gives each row a short vector of statistics; later passes read only that.
2. Standardised statistics go through random Fourier features, whose inner products approximate a
   Gaussian kernel (Rahimi and Recht 2007).  Every task sums the normal equations of its rows, per
   fold; the sums are added slice by slice in a second stage, so the driver gets one matrix per
   fold however many tasks there were.
3. Ridge regression is solved per left-out fold and for all folds.  Out-of-fold scores are counted
   in a fixed number of bins and calibrated by isotonic regression (pool adjacent violators).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import fold, prepared, stored, whole_text

STATISTICS = (
    "log_chars", "log_words", "log_lines", "mean_word", "spread_word", "distinct_words", "top_word", "distinct_pairs",
    "top_pair", "repeated_neighbours", "word_entropy", "byte_entropy", "upper", "digits", "punctuation", "exclamations",
    "bars", "non_ascii", "spaces", "distinct_lines", "short_words", "capital_words")
ROWS_PER_TASK, MOST_TASKS = 20_000, 1024
_PUNCTUATION = [c for c in range(33, 127) if not chr(c).isalnum()]


def _entropy(counts: np.ndarray) -> float:
    p = counts[counts > 0] / max(1, counts.sum())
    return float(-(p * np.log2(p)).sum()) if len(p) else 0.0


def statistics(text: str | None) -> list[float]:
    """The values of STATISTICS for a text; an empty text has zeros only."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = len(data)
    ws = data.split()
    lines = text.split("\n")
    share = lambda codes: float(counts[codes].sum()) / n
    if ws:
        h = np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws))
        size = np.fromiter(map(len, ws), np.float64, len(ws))
        each = np.unique(h, return_counts=True)[1]
        pairs = np.unique(h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:], return_counts=True)[1]
        words = [size.mean(), size.std(), len(each) / len(ws), each.max() / len(ws),
                 len(pairs) / max(1, len(ws) - 1), (pairs.max() if len(pairs) else 0) / len(ws),
                 float((h[1:] == h[:-1]).mean()) if len(ws) > 1 else 0.0, _entropy(each)]
        tail = [float((size <= 3).mean()), sum(w[:1].isupper() for w in ws) / len(ws)]
    else:
        words, tail = [0.0] * 8, [0.0, 0.0]
    return [float(x) for x in (
        np.log1p(n), np.log1p(len(ws)), np.log1p(len(lines)), *words, _entropy(counts), share(slice(65, 91)),
        share(slice(48, 58)), share(_PUNCTUATION), share([33]), share([124]), share(slice(128, 256)), share([32]),
        len(set(lines)) / len(lines), *tail)]


def statistics_of(text: str | Column = "text") -> Column:
    """array<double> of STATISTICS for a text column."""

    def stats(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([statistics(t) for t in texts], dtype=object)

    stats.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(stats, "array<double>")(whole_text(text))


@dataclass(frozen=True)
class Features:
    """Random Fourier features of standardised statistics, with an intercept in front."""

    mean: np.ndarray
    scale: np.ndarray
    turns: np.ndarray
    phase: np.ndarray

    @staticmethod
    def draw(mean: np.ndarray, scale: np.ndarray, size: int, width: float, seed: int) -> Features:
        rng = np.random.default_rng(seed)
        return Features(mean, scale, rng.normal(0, 1 / (width * np.sqrt(len(mean))), (len(mean), size)),
                        rng.uniform(0, 2 * np.pi, size))

    def of(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.ones((len(x), 1)), np.cos(z @ self.turns + self.phase) * np.sqrt(2 / len(self.phase))])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing weighted least-squares fit (pool adjacent violators)."""
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for a, b, w in zip(x, y, weight):
        blocks.append([w, w * b, w * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


@dataclass(frozen=True)
class QualityModel:
    features: Features | None
    weight: np.ndarray
    knots: np.ndarray
    values: np.ndarray
    rows: int

    def values_of(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), 0.5)
        return np.clip(np.interp(self.features.of(x) @ self.weight, self.knots, self.values), 0.0, 1.0)

    def score(self, stats: str | Column) -> Column:
        """Calibrated probability of label 1 for a column of statistics."""
        model = self

        def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in parts:
                yield pd.Series(model.values_of(np.array(s.tolist()).reshape(len(s), -1)) if len(s) else [], dtype="float64")

        scores.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(scores, "double")(F.col(stats) if isinstance(stats, str) else stats)


def _summed(rows: DataFrame, parts, shape: tuple[int, ...], slices: int) -> np.ndarray:
    """Sum over all rows of the arrays that ``parts(batch)`` yields: per task, then per slice."""
    size = int(np.prod(shape))
    cuts = [size * i // slices for i in range(slices + 1)]
    schema = pa.schema([("slice", pa.int32()), ("sums", pa.binary())])

    def per_task(batches):
        total = np.zeros(size)
        for b in batches:
            total += parts(b).ravel()
        for i in range(slices):
            yield pa.RecordBatch.from_pydict({"slice": [i], "sums": [total[cuts[i]:cuts[i + 1]].tobytes()]}, schema=schema)

    def per_slice(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for i, s in zip(b.column("slice").to_pylist(), b.column("sums").to_pylist()):
                total[i] = total.get(i, 0) + np.frombuffer(s)
        for i, t in total.items():
            yield pa.RecordBatch.from_pydict({"slice": [i], "sums": [t.tobytes()]}, schema=schema)

    out = np.zeros(size)
    kind = "slice int, sums binary"
    for r in rows.mapInArrow(per_task, kind).repartition("slice").mapInArrow(per_slice, kind).collect():
        out[cuts[r["slice"]]:cuts[r["slice"] + 1]] += np.frombuffer(r["sums"])
    return out.reshape(shape)


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", column: str = "stats",
        size: int = 256, width: float = 1.0, ridge: float = 1.0, bins: int = 2048, folds: int = 5,
        seed: int = 7) -> QualityModel:
    """Fit on the rows of ``stats`` (key, statistics) whose key has a label 0 or 1.  Keys with contradicting labels and null keys are left out.  Without any labelled
    row every score is 0.5."""
    spark = prepared(stats.sparkSession)
    known = (labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
             .where("k is not null and y in (0, 1)").groupBy("k")
             .agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").select("k", F.col("y").cast("double")))
    rows = stored(stats.select(F.col(key).alias("k"), F.col(column).alias("x")).join(known, "k").select(
        "x", "y", fold("k", folds).cast("int").alias("fold")), "quality-labelled")
    d = len(STATISTICS)

    def matrix(batch) -> np.ndarray:
        return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)

    def moments(batch):
        x = matrix(batch)
        return np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])

    m = _summed(rows, moments, (1 + 2 * d,), 1)
    n = int(m[0])
    if not n:
        return QualityModel(None, np.zeros(0), np.zeros(0), np.zeros(0), 0)
    mean = m[1:1 + d] / n
    scale = np.sqrt(np.maximum(m[1 + d:] / n - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0
    features = Features.draw(mean, scale, size, width, seed)
    p = size + 1
    # Every task adds one set of equations to what is shuffled: no more tasks than the rows need.
    rows = rows.coalesce(min(MOST_TASKS, -(-n // ROWS_PER_TASK)))

    def equations(batch):
        f, y = batch.column("fold").to_numpy(), batch.column("y").to_numpy()
        phi = features.of(matrix(batch))
        out = np.zeros((folds, p, p + 1))
        for k in np.unique(f):
            a = phi[f == k]
            out[k] += a.T @ np.hstack([a, y[f == k][:, None]])
        return out

    each = _summed(rows, equations, (folds, p, p + 1), folds * 4)
    everything = each.sum(axis=0)
    penalty = ridge * np.eye(p)
    penalty[0, 0] = 1e-6
    solve = lambda s: np.linalg.solve(s[:, :p] + penalty, s[:, p])
    weight, left_out = solve(everything), np.array([solve(everything - e) for e in each])
    low, high = -0.5, 1.5

    def counted(batch):
        f = batch.column("fold").to_numpy()
        s = np.einsum("ij,ij->i", features.of(matrix(batch)), left_out[f])
        at = np.clip((s - low) / (high - low) * bins, 0, bins - 1).astype(int)
        return np.stack([np.bincount(at, minlength=bins), np.bincount(at, batch.column("y").to_numpy(), bins)])

    count, positive = _summed(rows, counted, (2, bins), 1)
    on = count > 0
    centre = low + (np.arange(bins) + 0.5) * (high - low) / bins
    knots, values = isotonic(centre[on], positive[on] / count[on], count[on])
    return QualityModel(features, weight, knots, values, n)
