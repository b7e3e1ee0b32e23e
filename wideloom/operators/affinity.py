"""Affinity propagation on a nearest-neighbour similarity graph.

Messages live on edges (i, k), which stay in the part of their row i as arrays, so that its best
alternatives need no shuffle.  An exemplar k may be near to any share of all rows: a part sends one
sum of positive responsibilities for each k it has edges to, and gets one answer back.
With ``neighbors`` at least n - 1 the graph is complete and the result is the dense
algorithm's.
"""

from __future__ import annotations

import pickle
import warnings

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.operators.neighbors import nearest_neighbors
from wideloom.operators.quantiles import exact_quantiles
from wideloom.session import cores, cut_lineage, scratch_dir


def similarity_graph(df: DataFrame, key: str, vec: str, neighbors: int, preference: float | None = None) -> DataFrame:
    """(i, k, s): negative squared distances plus the preference on every (i, i)."""
    near = nearest_neighbors(df, key, vec, neighbors).select(
        F.col("key").alias("i"), F.col("neighbor").alias("k"), (-F.col("distance") * F.col("distance")).alias("s"))
    near = cut_lineage(near)
    self_edges = df.select(F.col(key).cast("bigint").alias("i")).withColumn("k", F.col("i"))
    if preference is None:  # median similarity, the zero diagonal included
        every = near.select("s").unionByName(self_edges.select(F.lit(0.0).alias("s")))
        preference = exact_quantiles(every, {"s": F.col("s")}, [0.5])["s"][0]
    return near.unionByName(self_edges.withColumn("s", F.lit(float(preference))))


def affinity_propagation(df: DataFrame, key: str, vec: str, damping: float = 0.5, max_iter: int = 200,
                         convergence_iter: int = 15, *, neighbors: int, preference: float | None = None
                         ) -> DataFrame:
    """(key, exemplar, converged): each row's exemplar row, and whether the choice had settled.

    At a damping of 0.5 the messages may swing for ever on sparse graphs, where 0.9 settles.

    The operator is the sparse algorithm: similarities beyond a row's ``neighbors`` nearest are
    minus infinity, also for the median preference.
    """
    spark = df.sparkSession
    e = cut_lineage(similarity_graph(df, key, vec, neighbors, preference).where("k IS NOT NULL"))
    edges = e.count()
    parts = max(1, min(2 * cores(spark), -(-edges // FEW)), -(-edges // PART))
    state = e.repartition(parts, "i").mapInArrow(_block, "part int, body binary").rdd.map(
        lambda row: (row[0], pickle.loads(row[1]))).partitionBy(parts, _same).persist(StorageLevel.MEMORY_AND_DISK)
    scratch_dir(spark)
    stable, before, settled = 0, None, False
    older = []
    for turn in range(max_iter):
        asked = state.mapValues(lambda b: _responsibilities(b, damping)).persist(StorageLevel.MEMORY_AND_DISK)
        answers = asked.flatMap(lambda p: _questions(*p, parts)).groupByKey(parts, _same).flatMap(
            _answers).groupByKey(parts, _same)
        new = asked.union(answers).groupByKey(parts, _same).mapValues(
            lambda both: _availabilities(both, damping)).persist(StorageLevel.MEMORY_AND_DISK)
        if turn % CUT == CUT - 1:
            new.checkpoint()  # the lineage stays short, and its files outlive a lost executor
        now = new.mapValues(_fingerprint).values().fold(0, _merge)
        older += [state, asked]
        if len(older) > 2:  # the state before this round is needed until the round is kept
            for old in older[:-2]:
                old.unpersist()
            older = older[-2:]
        state = new
        stable = stable + 1 if now == before else 0
        before = now
        if stable >= convergence_iter:
            settled = True
            break
    if not settled:
        warnings.warn(f"affinity propagation did not settle in {max_iter} rounds", stacklevel=2)
    chosen = state.flatMap(lambda p: [(None if i == NOBODY else i, k) for i, k in zip(*(x.tolist() for x in _exemplars(p[1])))])
    try:
        found = cut_lineage(spark.createDataFrame(chosen, "i bigint, k bigint"))
    finally:
        for old in (*older, state):
            old.unpersist()
    return found.select(F.col("i").alias(key), F.col("k").alias("exemplar"), F.lit(settled).alias("converged"))


PART = 1 << 20  # edges of one part at most, whose messages a task updates as arrays
FEW = 1 << 15  # edges that are worth a part of their own
CUT = 20  # rounds between checkpoints
NOBODY = -2 ** 63  # stands for a null key


def _same(part: int) -> int:
    return part


def _merge(a: int, b: int) -> int:
    return (a + b) % 2 ** 64


def _block(batches):
    """The edges of one partition, sorted by row and then by target, with no messages yet."""
    tables = [b for b in batches if b.num_rows]
    if tables:
        t = pa.Table.from_batches(tables)
        i = t["i"].fill_null(NOBODY).to_numpy()
        k, s = t["k"].to_numpy(), t["s"].to_numpy()
        order = np.lexsort((k, i))
        i, k, s = i[order], k[order], s[order]
        body = {"i": i, "k": k, "s": s, "r": np.zeros(len(i)), "a": np.zeros(len(i)),
                "first": np.append(0, np.flatnonzero(np.diff(i)) + 1)}
        body["to"], body["at"] = np.unique(k, return_inverse=True)
        yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          "body": pa.array([pickle.dumps(body, pickle.HIGHEST_PROTOCOL)], pa.binary())})


def _responsibilities(b: dict, damping: float) -> dict:
    """max over k' != k of a + s: the best alternative, or the second best for the best k."""
    v, first = b["a"] + b["s"], b["first"]
    size = np.diff(np.append(first, len(v)))
    best = np.maximum.reduceat(v, first).repeat(size)
    top = np.maximum.reduceat(np.where(v == best, b["k"], NOBODY), first).repeat(size)
    on = b["k"] == top
    second = np.maximum.reduceat(np.where(on, -np.inf, v), first).repeat(size)
    other = np.where(on, second, best)
    other = np.where(np.isneginf(other), -1e300, other)
    r = np.clip(damping * b["r"] + (1.0 - damping) * (b["s"] - other), -1e300, 1e300)
    return {**b, "r": r}


def _questions(part: int, b: dict, parts: int):
    """To the part of every target: this part's positive responsibilities for it, and its own for itself."""
    own = b["i"] == b["k"]
    pos = np.where(own | (b["i"] == NOBODY), 0.0, np.maximum(b["r"], 0.0))
    total = np.bincount(b["at"], pos, len(b["to"]))
    self_r = np.full(len(b["to"]), -np.inf)
    np.maximum.at(self_r, b["at"][own], b["r"][own])
    home = b["to"] % parts
    for to in np.unique(home).tolist():
        on = home == to
        yield to, (part, b["to"][on], total[on], self_r[on])


def _answers(message):
    """Sums over all parts, sent back to each part for the targets that it asked for."""
    asked = sorted(message[1], key=lambda q: q[0])  # a sum does not depend on the order of arrival
    every, at = np.unique(np.concatenate([q[1] for q in asked]), return_inverse=True)
    total = np.bincount(at, np.concatenate([q[2] for q in asked]), len(every))
    self_r = np.full(len(every), -np.inf)
    np.maximum.at(self_r, at, np.concatenate([q[3] for q in asked]))
    for part, to, _, _ in asked:
        on = np.searchsorted(every, to)
        yield part, (to, total[on], self_r[on])


def _availabilities(both, damping: float) -> dict:
    """From a part's edges and the answers it got."""
    b = next(x for x in both if isinstance(x, dict))
    answers = [y for x in both if not isinstance(x, dict) for y in x]
    total, self_r = np.zeros(len(b["to"])), np.zeros(len(b["to"]))
    for to, t, r in answers:
        on = np.searchsorted(b["to"], to)
        total[on], self_r[on] = t, r
    total, self_r, own = total[b["at"]], self_r[b["at"]], b["i"] == b["k"]
    others = np.minimum(0.0, np.where(np.isneginf(self_r), 0.0, self_r) + total - np.maximum(b["r"], 0.0))
    a = np.where(own, total, np.where(np.isneginf(self_r), 0.0, others))
    return {**b, "a": damping * b["a"] + (1.0 - damping) * a}


def _exemplars(b: dict) -> tuple[np.ndarray, np.ndarray]:
    """Each row's target with the largest a + r, the smallest of equal ones."""
    v, first = b["a"] + b["r"], b["first"]
    size = np.diff(np.append(first, len(v)))
    best = v == np.maximum.reduceat(v, first).repeat(size)
    return b["i"][first], np.minimum.reduceat(np.where(best, b["k"], np.iinfo(np.int64).max), first)


def _fingerprint(b: dict) -> int:
    """A sum over the rows' choices that a changed choice changes."""
    i, k = _exemplars(b)
    z = (i.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ k.view(np.uint64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return int((z ^ (z >> np.uint64(31))).sum(dtype=np.uint64))
