"""Vector columns: ``array<double>`` built from, and taken apart into, wide columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf


def pack(cols: Sequence[str | Column]) -> Column:
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])


def unpack(vec: str, names: Sequence[str]) -> list[Column]:
    return [F.col(vec)[i].alias(n) for i, n in enumerate(names)]


def to_matrix(column: pa.Array) -> np.ndarray:
    """Arrow list column -> float64 matrix; no per-row Python objects.

    Vectors must be present and of one width; a null entry becomes NaN.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError(f"{column.null_count} null vectors: filter or fill them first")
    size = np.diff(column.offsets.to_numpy())
    if (size != size[0]).any():
        raise ValueError(f"vectors of different widths ({size.min()} to {size.max()})")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype=np.float64).reshape(len(column), -1)


def to_complete_matrix(column: pa.Array) -> np.ndarray:
    """Like ``to_matrix``, but for fits: a null or NaN entry is an error, not a poisoned sum."""
    m = to_matrix(column)
    if np.isnan(m.sum()) and np.isnan(m).any():
        raise ValueError("null or NaN entries in a vector column: impute them first")
    return m


def _complete_rows(column: pa.Array) -> tuple[pa.Array, np.ndarray | None]:
    """The rows that have a vector without null entries, and which they are (None: all)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not column.null_count and not column.flatten().null_count:
        return column, None
    ok = np.array([v is not None and None not in v for v in column.to_pylist()], bool)
    return column.filter(pa.array(ok)), ok


def _with_nulls(values: pa.Array, ok: np.ndarray | None) -> pa.Array:
    if ok is None:
        return values
    at = np.cumsum(ok) - 1
    return values.take(pa.array(np.where(ok, at, 0), mask=~ok))


def from_matrix(m: np.ndarray) -> pa.Array:
    m = np.ascontiguousarray(m, dtype=np.float64)
    offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32) if len(m) else np.zeros(1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel()))


def matrix_column(fn: Callable[[np.ndarray], np.ndarray], vec: str | Column) -> Column:
    """Apply a batch function matrix -> matrix as a lazy column expression; a null vector, or one
    with a null entry, gives null."""

    @arrow_udf("array<double>")
    def run(x: pa.Array) -> pa.Array:
        x, ok = _complete_rows(x)
        if not len(x):
            return pa.nulls(0 if ok is None else len(ok), pa.list_(pa.float64()))
        return _with_nulls(from_matrix(fn(to_matrix(x))), ok)

    return run(vec)


def scalar_column(fn: Callable[[np.ndarray], np.ndarray], vec: str | Column, kind: str = "double") -> Column:
    """Apply a batch function matrix -> vector as a lazy column expression; nulls as above."""
    arrow = {"double": pa.float64(), "int": pa.int32(), "bigint": pa.int64()}[kind]

    @arrow_udf(kind)
    def run(x: pa.Array) -> pa.Array:
        x, ok = _complete_rows(x)
        if not len(x):
            return pa.nulls(0 if ok is None else len(ok), arrow)
        return _with_nulls(pa.array(np.asarray(fn(to_matrix(x))), type=arrow), ok)

    return run(vec)


BATCH_BYTES = 16 << 20  # numbers of one Arrow batch; a worker holds a few copies at a time


def fit_batches(df: DataFrame, wide: int) -> None:
    """Keep the session's Arrow batches within ``BATCH_BYTES`` for vectors of ``wide`` entries.

    Spark's 10,000 rows to a batch are hundreds of MB of wide vectors in every Python worker; a size
    that is already smaller stays.
    """
    name, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", max(64, BATCH_BYTES // (8 * max(wide, 1)))
    have = int(df.sparkSession.conf.get(name))
    if have <= 0 or have > rows:
        df.sparkSession.conf.set(name, str(rows))


def width(df: DataFrame, vec: str) -> int:
    """Number of entries of the vector column, read from one row."""
    row = df.select(F.size(vec).alias("p")).where(F.col("p") > 0).first()
    if row is None:
        raise ValueError(f"no rows with a non-empty vector in {vec!r}")
    return int(row["p"])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def literal_vector(v: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])
