"""Distributed sums of fixed-size arrays over rows.

Nearly every fit in this package is "sum some small arrays over all rows": Gram
matrices, centroids, EM statistics, histograms.  Each task folds its Arrow batches
into one set of arrays with NumPy; only those partial sums move.  The scan keeps all its
tasks.  Many or large partial sums are added up by reducers first, by way of about sqrt(tasks)
of them if there are many, and one result reaches the driver however many tasks there are.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.functions.vectors import to_complete_matrix, to_matrix

DIRECT = 64  # partial sums taken straight to the driver up to this many tasks ...
DIRECT_BYTES = 1 << 20  # ... and this many bytes in all: an iterative fit takes hundreds of such sums

CHUNK = 1 << 16  # numbers per partial row: wide Gram matrices travel in 512 KB pieces

PARTIAL = "task int, chunk int, shapes string, body binary"


def _column(batch: pa.RecordBatch, i: int, complete: bool) -> np.ndarray:
    col = batch.column(i)
    if pa.types.is_list(col.type):
        return to_complete_matrix(col) if complete else to_matrix(col)
    return col.to_numpy(zero_copy_only=False)


def _pack(task: int, arrays: Sequence[np.ndarray], whole: bool) -> dict[str, list]:
    flat = np.concatenate([np.asarray(a, np.float64).ravel() for a in arrays])
    step = max(1, len(flat)) if whole else CHUNK
    bodies = [flat[i:i + step].tobytes() for i in range(0, max(1, len(flat)), step)]
    shapes = json.dumps([list(a.shape) for a in arrays])
    return {"task": [task] * len(bodies), "chunk": list(range(len(bodies))), "shapes": [shapes] * len(bodies),
            "body": bodies}


def _unpack(shapes: str, body: bytes) -> list[np.ndarray]:
    flat, out, at = np.frombuffer(body, np.float64), [], 0
    for shape in json.loads(shapes):
        size = int(np.prod(shape)) if shape else 1
        out.append(flat[at:at + size].reshape(shape).copy())
        at += size
    return out


def _sum_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("task")  # a sum does not depend on the order of arrival
    total = np.frombuffer(pdf["body"].iloc[0], np.float64).copy()
    for body in pdf["body"].iloc[1:]:
        total += np.frombuffer(body, np.float64)
    return pd.DataFrame({"task": [int(pdf["task"].iloc[0])], "chunk": [int(pdf["chunk"].iloc[0])],
                         "shapes": [pdf["shapes"].iloc[0]], "body": [total.tobytes()]})


Arrays = Sequence[np.ndarray]


def add(a: Arrays, b: Arrays) -> Arrays:
    return [x + y for x, y in zip(a, b)]


def keep_smallest(a: Arrays, b: Arrays) -> Arrays:
    """Merge of (scores, payload rows...): entry by entry, the side with the lower score."""
    take = b[0] < a[0]
    return [np.where(take.reshape(take.shape + (1,) * (x.ndim - take.ndim)), y, x) for x, y in zip(a, b)]


def task_count(df: DataFrame) -> int:
    """How many tasks the last stage of ``df`` has, or at most has.

    A plan that still has to shuffle is not run to find out: it has at most the configured
    number of shuffle partitions.
    """
    known = getattr(df, "_task_count", None)  # iterative fits ask for the same frame every round
    if known is None:
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "InMemoryTableScan" not in plan and "Exchange" in plan:
            known = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        else:
            known = max(1, df.rdd.getNumPartitions())
        df._task_count = known
    return known


class KeptRows:
    """Columns of a frame kept as cached NumPy blocks, one per Arrow batch, for fits that pass over
    the same rows many times: a pass reads arrays and plans no query.

    Checks of ``complete`` vectors are made when the blocks are built.
    """

    def __init__(self, df: DataFrame, columns: Sequence[str], complete: bool = True):
        picked, self.columns = df.select(*columns), list(columns)
        wide = range(len(self.columns))

        def block(batches):
            for batch in batches:
                if batch.num_rows:
                    arrays = [_column(batch, i, complete) for i in wide]
                    yield pa.RecordBatch.from_pydict({"body": [pickle.dumps(arrays, pickle.HIGHEST_PROTOCOL)]}, schema=BLOCK)

        self.blocks = picked.mapInArrow(block, "body binary").rdd.map(lambda r: pickle.loads(r[0])).persist(
            StorageLevel.MEMORY_AND_DISK)
        self.tasks = max(1, self.blocks.getNumPartitions())

    def width(self, column: str) -> int:
        at = self.columns.index(column)
        found = self.blocks.map(lambda block: block[at].shape[1]).take(1)
        if not found:
            raise ValueError("no rows to fit on")
        return found[0]

    def unpersist(self) -> None:
        self.blocks.unpersist()

    def sum(self, columns: Sequence[str], fn: Callable[..., Arrays], merge: Callable[[Arrays, Arrays], Arrays],
            numbers: int) -> list[np.ndarray]:
        at, summed = [self.columns.index(c) for c in columns], merge is add

        def fold(task, blocks):
            total = None
            for block in blocks:
                part = [np.asarray(a, np.float64) for a in fn(*[block[i] for i in at])]
                total = part if total is None else merge(total, part)
            return [] if total is None else [(task, total)]

        def merged(parts):
            total = None
            for _, part in sorted(parts, key=lambda p: p[0]):  # a sum does not depend on the order of arrival
                total = part if total is None else merge(total, part)
            return total

        partial = self.blocks.mapPartitionsWithIndex(fold)
        if self.tasks <= DIRECT and 8 * self.tasks * numbers <= DIRECT_BYTES:
            found = partial.collect()
            if not found:
                raise ValueError("no rows to sum")
            return list(merged(found))
        slots = math.isqrt(self.tasks) if self.tasks > DIRECT else 1
        if not summed:  # only element-wise sums may travel in pieces
            if slots > 1:
                partial = partial.map(lambda p: (p[0] % slots, p)).groupByKey(slots).mapValues(merged)
            found = partial.map(lambda p: (0, p)).groupByKey(1).mapValues(merged).values().collect()
            if not found:
                raise ValueError("no rows to sum")
            return list(found[0])

        def pieces(part):
            task, arrays = part
            flat = np.concatenate([a.ravel() for a in arrays])
            shapes = [a.shape for a in arrays]
            return [(i, (task, [flat[i * CHUNK:(i + 1) * CHUNK]], shapes)) for i in range(max(1, -(-len(flat) // CHUNK)))]

        def one(parts):
            parts = list(parts)
            return min(p[0] for p in parts), merged([p[:2] for p in parts]), parts[0][2]

        cut = partial.flatMap(pieces)
        count = max(1, min(self.tasks, -(-numbers // CHUNK)))
        if slots > 1:
            cut = cut.map(lambda p: ((p[0], p[1][0] % slots), p[1])).groupByKey(max(count, slots)).map(
                lambda p: (p[0][0], one(p[1])))
        found = dict(cut.groupByKey(count).mapValues(one).collect())
        if not found:
            raise ValueError("no rows to sum")
        flat, out, start = np.concatenate([found[i][1][0] for i in range(len(found))]), [], 0
        for shape in found[0][2]:
            size = int(np.prod(shape))
            out.append(flat[start:start + size].reshape(shape).copy())
            start += size
        return out


def sum_rows(
    df: DataFrame | KeptRows, columns: Sequence[str], fn: Callable[..., Arrays], merge: Callable[[Arrays, Arrays], Arrays] = add,
    numbers: int = 100_000, complete: bool = True,
) -> list[np.ndarray]:
    """Fold ``fn(*column_arrays)`` over all batches of ``df``; by default a sum.

    Vector columns reach ``fn`` as matrices, scalar columns as 1-d arrays.  ``merge`` must
    be associative and commutative.  ``numbers`` is about how many numbers one result has: partial
    results of more than ``DIRECT_BYTES`` in all are merged before the driver sees them.
    Null vectors and unequal widths raise, and so do missing entries unless ``complete`` is false
    (they are NaN then).
    """
    if isinstance(df, KeptRows):
        return df.sum(columns, fn, merge, numbers)
    picked = df.select(*columns)
    tasks = task_count(df)
    direct = tasks <= DIRECT and 8 * tasks * numbers <= DIRECT_BYTES
    whole = merge is not add  # only element-wise sums may travel in pieces

    def fold(batches):
        total = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            part = [np.asarray(a, np.float64) for a in fn(*[_column(batch, i, complete) for i in range(len(columns))])]
            total = part if total is None else merge(total, part)
        if total is not None:
            rows = _pack(TaskContext.get().partitionId(), total, whole)
            for i in range(len(rows["body"])):
                yield pa.RecordBatch.from_pydict({k: [v[i]] for k, v in rows.items()}, schema=SCHEMA)

    def merge_whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, total = pdf.sort_values("task"), None
        for shapes, body in zip(pdf["shapes"], pdf["body"]):
            part = _unpack(shapes, body)
            total = part if total is None else merge(total, part)
        return pd.DataFrame(_pack(int(pdf["task"].iloc[0]), total, True))

    partial = picked.mapInArrow(fold, PARTIAL)
    if not direct:
        step = merge_whole if whole else _sum_chunk
        if tasks > DIRECT:  # few partial results to a reducer
            slot = F.pmod("task", F.lit(max(1, math.isqrt(tasks))))
            partial = partial.groupBy(slot, "chunk").applyInPandas(step, PARTIAL)
        partial = partial.groupBy("chunk").applyInPandas(step, PARTIAL)
    rows = partial.collect() if direct else partial.toLocalIterator()
    if whole:
        total = None
        for row in rows:
            part = _unpack(row["shapes"], row["body"])
            total = part if total is None else merge(total, part)
        if total is None:
            raise ValueError("no rows to sum")
        return list(total)
    pieces: dict[int, np.ndarray] = {}
    shapes = None
    for row in rows:
        shapes, body = row["shapes"], np.frombuffer(row["body"], np.float64)
        pieces[row["chunk"]] = pieces[row["chunk"]] + body if row["chunk"] in pieces else body
    if shapes is None:
        raise ValueError("no rows to sum")
    return _unpack(shapes, np.concatenate([pieces[i] for i in range(len(pieces))]).tobytes())


SCHEMA = pa.schema([("task", pa.int32()), ("chunk", pa.int32()), ("shapes", pa.string()), ("body", pa.binary())])
BLOCK = pa.schema([("body", pa.binary())])
