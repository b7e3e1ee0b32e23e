"""Neighbour graphs as edge tables: built at any size, refined, made symmetric and connected.

``neighbor_graph`` is approximate, with exact distances.  Its work per row is bounded: a row meets the
rows of its leaves and, per round, the neighbours of its neighbours, however many rows there are.

1. Pivot trees.  A tree has levels of at most ``MAX_PIVOTS`` pivots: the first level's are rows, the
   next ones' are what rows differ from their pivots, so a few hundred vectors make as many cells as
   their counts multiply to, and nothing that is broadcast grows with the rows.  Cells over ``leaf``
   rows are split; the rows of a piece are compared with each other.
2. Descent.  A round brings together, at every row, its neighbours and some of those that have it as
   theirs; each of them learns which of the others are near.  Rounds end when hardly any edge moves.

``neighbors.nearest_neighbors`` is the exact form; its work per row grows with the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.joins import join_groups, measured_broadcast
from wideloom.functions.vectors import to_complete_matrix
from wideloom.operators.components import connected_components
from wideloom.operators.neighbors import pair_distances
from wideloom.operators.reduce import landmarks
from wideloom.session import cut_lineage

MAX_PIVOTS = 512
EDGES = "key bigint, neighbor bigint, distance double"


def _levels(rows: int, leaf: int) -> list[int]:
    """Pivots per level, so that the cells hold about half a leaf each."""
    cells = max(1.0, 2 * rows / leaf)
    deep = max(1, math.ceil(math.log(cells) / math.log(MAX_PIVOTS)))
    return [max(1, math.ceil(cells ** (1 / deep)))] * deep


def _tree(points: DataFrame, levels: list[int], seed: int) -> list[np.ndarray]:
    """Pivots per level, from a bounded sample: rows, then their residuals at the level before."""
    out: list[np.ndarray] = []
    for depth, size in enumerate(levels):
        x = landmarks(points, "key", "vec", size, seed + depth)
        for pivots in out:
            x = x - pivots[pair_distances(x, pivots).argmin(axis=1)]
        out.append(x)
    return out


def _cells(trees: list[list[np.ndarray]]):
    """The row's cell in each tree, as one number."""

    @arrow_udf("array<bigint>")
    def run(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(pa.int64()))
        rows = to_complete_matrix(x)
        out = np.zeros((len(rows), len(trees)), np.int64)
        for t, levels in enumerate(trees):
            rest = rows
            for pivots in levels:
                at = pair_distances(rest, pivots).argmin(axis=1)
                out[:, t] = out[:, t] * len(pivots) + at
                rest = rest - pivots[at]
        offsets = np.arange(0, out.size + 1, len(trees), dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return run


def _near(key: np.ndarray, dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest others within a group, as edges."""
    np.fill_diagonal(dist, np.inf)
    m = min(k, len(key) - 1)
    order = np.argpartition(dist, m - 1, axis=1)[:, :m]
    return np.repeat(key, m), key[order].ravel(), np.take_along_axis(dist, order, axis=1).ravel()


def _edges(found: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["key", "neighbor", "distance"])


def sorted_groups(batches: Iterator[pa.RecordBatch], cols: list[str]) -> Iterator[list[tuple[int, int]] | pa.Table]:
    """Tables of whole groups of rows equal in ``cols`` (which the partition is sorted by), each with its
    groups' bounds; a group that goes on in the next batch is held back."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows < 1 << 13:
            continue
        table = pa.Table.from_batches(held)
        cut = _starts(table, cols)[-1]
        if cut:
            yield _with_bounds(table.slice(0, cut), cols)
        held, rows = table.slice(cut).to_batches(), len(table) - cut
    if rows:
        yield _with_bounds(pa.Table.from_batches(held), cols)


def _starts(table: pa.Table, cols: list[str]) -> np.ndarray:
    new = np.zeros(len(table), bool)
    new[0] = True
    for c in cols:
        x = table.column(c).to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _with_bounds(table: pa.Table, cols: list[str]) -> tuple[pa.Table, list[tuple[int, int]]]:
    at = _starts(table, cols)
    return table.combine_chunks(), list(zip(at.tolist(), [*at[1:].tolist(), len(table)]))


def _leaf_edges(k: int):
    def run(batches):
        for table, bounds in sorted_groups(batches, ["tree", "cell", "piece"]):
            key, vec = table.column("key").to_numpy(), to_complete_matrix(table.column("vec"))
            found = [_near(key[a:b], pair_distances(vec[a:b], vec[a:b]), k) for a, b in bounds if b - a > 1]
            if found:
                yield _edges(found)

    return run


def _meeting_edges(k: int):
    def run(batches):
        for table, bounds in sorted_groups(batches, ["center"]):
            key, vec, reach = table.column("key").to_numpy(), to_complete_matrix(table.column("vec")), table.column("reach").to_numpy()
            found = []
            for a, b in bounds:
                own, first = np.unique(key[a:b], return_index=True)  # met both ways
                if len(own) > 1:
                    v = vec[a:b][first]
                    edges = _near(own, pair_distances(v, v), k)
                    near = edges[2] <= np.repeat(reach[a:b][first], len(edges[0]) // len(own))
                    if near.any():
                        found.append(tuple(e[near] for e in edges))
            if found:
                yield _edges(found)

    return run


def nearest_edges(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest different neighbours per key; one shuffle."""
    once = edges.repartition("key").groupBy("key", "neighbor").agg(F.min("distance").alias("distance"))
    best = F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbor"))), 1, k)
    return once.groupBy("key").agg(best.alias("b")).select("key", F.explode("b").alias("b")).select("key", "b.neighbor", "b.distance")


def _meetings(points: DataFrame, edges: DataFrame, rows: int, k: int, turn: int) -> DataFrame:
    """(center, key, vec, reach): at each row its neighbours, about k of those it is a neighbour of, and itself.

    ``reach`` is the distance of the row's k-th neighbour: what is further cannot be among its k nearest, so
    a meeting need not report it.  A row that is a neighbour of very many lets each of them come with the same small chance.
    """
    degree = edges.groupBy(F.col("neighbor").alias("center")).agg(F.count("*").alias("n"))
    back = join_groups(edges.select(F.col("neighbor").alias("center"), "key"),
                       degree.select("center", "n", F.col("n").alias("weight")), "center", "weight", rows * k)
    chance = F.pmod(F.xxhash64("center", "key", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    met = edges.select(F.col("key").alias("center"), F.col("neighbor").alias("key")).unionByName(
        back.where(chance < k / F.col("n")).select("center", "key")).unionByName(
        points.select(F.col("key").alias("center"), "key"))
    held = met.groupBy("key").agg(F.count("*").alias("weight"))
    known = edges.groupBy("key").agg(F.max("distance").alias("last"), F.count("*").alias("c")).select(
        "key", F.when(F.col("c") >= k, F.col("last")).alias("last"))
    vectors = points.join(held, "key").join(known, "key", "left").select(
        "key", "vec", "weight", F.coalesce("last", F.lit(float("inf"))).alias("reach"))
    return join_groups(met, vectors, "key", "weight", 3 * rows * k, limit=10_000)


def neighbor_graph(df: DataFrame, key: str, vec: str, k: int, trees: int = 4, leaf: int = 1024, rounds: int = 6,
                   width: int | None = None, seed: int = 42) -> DataFrame:
    """(key, neighbor, distance): about the k nearest other rows of every row.

    ``key`` is an integer without repeats.  ``width`` neighbours (k + 10 if not given) are kept while
    searching; a round that shortens the distances by less than a thousandth is the last.  With at most
    ``leaf`` / 2 rows a tree is one leaf and the result exact.
    """
    points = cut_lineage(df.select(F.col(key).cast("bigint").alias("key"), F.col(vec).alias("vec")).where("vec is not null"))
    n = points.count()
    width = k + 10 if width is None else max(k, width)
    levels = _levels(n, leaf)
    forest = [_tree(points, levels, seed + 1000 * t) for t in range(trees if math.prod(levels) > 1 else 1)]
    placed = points.withColumn("cells", _cells(forest)("vec")).select("key", "vec", F.posexplode("cells").alias("tree", "cell"))
    sizes = placed.groupBy("tree", "cell").agg(F.count("*").alias("n"))
    pieces = sizes.select("tree", "cell", F.ceil(F.col("n") / leaf).cast("int").alias("pieces"))
    leaves = placed.join(measured_broadcast(pieces), ["tree", "cell"]).withColumn(
        "piece", F.pmod(F.xxhash64("key", "tree"), F.col("pieces")).cast("int"))
    dealt = leaves.select("tree", "cell", "piece", "key", "vec").repartition("tree", "cell", "piece").sortWithinPartitions("tree", "cell", "piece")
    edges = cut_lineage(nearest_edges(dealt.mapInArrow(_leaf_edges(width), EDGES), width))
    if math.prod(levels) > 1:
        before = None
        for turn in range(rounds):
            met = _meetings(points, edges, n, width, turn).repartition("center").sortWithinPartitions("center")
            found = met.select("center", "key", "vec", "reach").mapInArrow(_meeting_edges(width), EDGES)
            edges = cut_lineage(nearest_edges(edges.unionByName(found), width))
            total, count = edges.agg(F.sum("distance"), F.count("*")).first()
            if before is not None and count == before[1] and before[0] - total <= 1e-3 * before[0]:
                break
            before = total, count
    return nearest_edges(edges, k) if width > k else edges


def undirected(edges: DataFrame) -> DataFrame:
    """(i, j, distance) with every edge in both directions, once each."""
    both = edges.select(F.col("key").alias("i"), F.col("neighbor").alias("j"), "distance")
    return both.unionByName(both.select(F.col("j").alias("i"), F.col("i").alias("j"), "distance")).groupBy("i", "j").agg(
        F.min("distance").alias("distance"))


def graph_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(i, root) for every row of ``nodes`` (i): the smallest node of its component."""
    roots = connected_components(edges.select(F.lit(0).alias("run"), F.col("i").alias("u"), F.col("j").alias("v")))
    return nodes.join(roots.select(F.col("node").alias("i"), "root"), "i", "left").select("i", F.coalesce("root", "i").alias("root"))


def recall(edges: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours (ties at the last distance count either way) that ``edges`` has."""
    far = exact.groupBy("key").agg(F.max("distance").alias("far"), F.count("*").alias("k"))
    hit = edges.join(far, "key").where(F.col("distance") <= F.col("far") * (1 + 1e-9) + 1e-12).groupBy("key").agg(F.count("*").alias("hit"))
    r = far.join(hit, "key", "left").agg(F.sum(F.least(F.coalesce("hit", F.lit(0)), "k")), F.sum("k")).first()
    return float(r[0] / r[1])
