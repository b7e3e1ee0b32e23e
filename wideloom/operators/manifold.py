"""Embeddings of a neighbour graph: spectral embedding, Isomap and locally linear embedding.

The graph is an edge table and a vector over its nodes a column, so a product with the graph's matrix
is one join and one sum per node.  What reaches the driver has the size of the basis or the number of
landmarks, never of the rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.joins import join_groups
from wideloom.functions.vectors import from_matrix, matrix_column, to_complete_matrix
from wideloom.operators.graph import graph_components, nearest_edges, undirected
from wideloom.operators.neighbors import nearest_neighbors, pair_distances
from wideloom.operators.reduce import landmarks
from wideloom.operators.rowsums import sum_rows
from wideloom.session import cut_lineage

MAX_LANDMARKS = 512
VECTORS = 20_000  # nodes whose vectors may be broadcast
SPARE = 10  # more neighbours are searched where keys repeat, as copies of a key count once


def neighbor_edges(df: DataFrame, key: str, vec: str, k: int) -> DataFrame:
    """(key, neighbor, distance) of the k nearest other rows, exact at every size.

    Where keys repeat, rows are told apart while searching and a neighbour counts once per key.
    """
    points = cut_lineage(df.select(F.col(key).cast("bigint").alias("key"), F.col(vec).alias("vec")).where("vec is not null"))
    rows, keys = points.agg(F.count("*"), F.count_distinct("key")).first()
    if rows == keys:
        return cut_lineage(nearest_neighbors(points, "key", "vec", k, rows))
    own = cut_lineage(points.withColumn("row", F.monotonically_increasing_id()))
    found = nearest_neighbors(own, "row", "vec", k + SPARE, rows)
    names = own.select("row", F.col("key").alias("name"))
    one = found.withColumnRenamed("key", "row").join(names, "row").select(F.col("name").alias("key"), F.col("neighbor").alias("row"), "distance")
    return cut_lineage(nearest_edges(one.join(names, "row").select("key", F.col("name").alias("neighbor"), "distance"), k))


# ---- sparse products and eigenvectors ----------------------------------------------------------

def sparse_product(edges: DataFrame, x: DataFrame, width: int, total: int) -> DataFrame:
    """(i, y): for every i the sum over its edges of w times x at j, an array of ``width`` numbers.

    ``edges`` are (i, j, w), ``x`` is (j, x, weight) with the number of edges that end in j, ``total``
    that of all edges: a node in a large share of them is matched by broadcast.
    """
    met = join_groups(edges, x, "j", "weight", total, VECTORS)
    sums = met.groupBy("i").agg(*[F.sum(F.col("w") * F.col("x")[c]).alias(f"y{c}") for c in range(width)])
    return sums.select("i", F.array(*[f"y{c}" for c in range(width)]).alias("y"))


def _gram(df: DataFrame, cols: Sequence[str], numbers: int) -> np.ndarray:
    """Products of all entries of the columns with each other, summed over the rows."""

    def part(*blocks):
        x = np.concatenate(blocks, axis=1)
        return [x.T @ x]

    return sum_rows(df, list(cols), part, numbers=numbers * numbers)[0]


def _ritz(g: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, coefficients, residuals), largest values first, from the Gram matrix of [V, AV]."""
    s, h, aa = g[:d, :d], (g[:d, d:] + g[:d, d:].T) / 2, g[d:, d:]
    e, u = np.linalg.eigh(s)
    keep = e > 1e-10 * e[-1]
    white = u[:, keep] / np.sqrt(e[keep])
    values, z = np.linalg.eigh(white.T @ h @ white)
    order = np.argsort(-values)
    values, coef = values[order], white @ z[:, order]
    res = np.einsum("ij,ik,kj->j", coef, aa, coef) - 2 * values * np.einsum("ij,ik,kj->j", coef, h, coef) + values ** 2
    return values, coef, np.sqrt(np.maximum(res, 0))


def largest_eigenvectors(product: Callable[[DataFrame, int], DataFrame], nodes: DataFrame, count: int, block: int | None = None,
                         depth: int = 8, cycles: int = 12, tol: float = 1e-6) -> tuple[np.ndarray, DataFrame]:
    """(values, (i, vector)): the ``count`` largest eigenvalues of a symmetric operator with their vectors.

    ``product(x, width)`` applies it to (i, x).  A cycle grows a block Krylov basis of ``depth`` blocks,
    solves the projected problem and starts again from the best vectors; it ends when all residuals
    are below ``tol``.  Each vector's largest entry is positive.
    """
    block = count + 4 if block is None else block
    start = F.array(*[F.xxhash64("i", F.lit(c)) / F.lit(2.0 ** 63) for c in range(block)])
    basis = cut_lineage(nodes.select("i", start.alias("v"), F.array().cast("array<double>").alias("av")))
    fresh, done, tall = 0, 0, block  # entries of v whose product is known; of all
    values, coef, residual = np.zeros(0), np.zeros((0, 0)), np.zeros(0)
    for cycle in range(cycles):
        for _ in range(depth):
            new = tall - done
            if not new:
                break
            y = product(basis.select("i", F.slice("v", done + 1, new).alias("x")), new).withColumnRenamed("i", "_i")
            zero = F.array_repeat(F.lit(0.0), new)
            basis = cut_lineage(basis.join(y, F.col("i") == F.col("_i"), "left").select(
                "i", "v", F.concat("av", F.coalesce("y", zero)).alias("av")))
            g = _gram(basis, ["v", "av"], 2 * tall)
            done = tall
            values, coef, residual = _ritz(g, tall)
            if len(values) < count or (residual[:count] < tol).all() or tall + new > block * depth:
                break
            # The next block: the last product without its part in the basis, made orthonormal.
            s, c, yy = g[:tall, :tall], g[:tall, 2 * tall - new:], g[2 * tall - new:, 2 * tall - new:]
            inside = np.linalg.lstsq(s, c, rcond=1e-12)[0]
            e, u = np.linalg.eigh(yy - c.T @ inside)
            ok = e > 1e-9 * max(np.diag(yy).max(), 1e-300)
            if not ok.any():
                break
            turn = u[:, ok] / np.sqrt(e[ok])
            back = -inside @ turn
            both = matrix_column(lambda x, t=tall, n=new, b=back, r=turn: x[:, :t] @ b + x[:, -n:] @ r, F.concat("v", "av"))
            basis = basis.withColumn("v", F.concat("v", both))
            tall += int(ok.sum())
        if len(values) < count or (residual[:count] < tol).all() or done < tall:
            break
        if cycle + 1 < cycles:
            keep = min(block, len(values))
            pick = coef[:, :keep]
            t = len(coef)
            v, av = (matrix_column(lambda x, p=pick, t=t: x[:, :t] @ p, c) for c in ("v", "av"))
            basis = cut_lineage(basis.select("i", v.alias("v"), av.alias("av")))
            # A known product: the residuals are the next block.
            g = _gram(basis, ["v", "av"], 2 * keep)
            s, c, yy = g[:keep, :keep], g[:keep, keep:], g[keep:, keep:]
            inside = np.linalg.lstsq(s, c, rcond=1e-12)[0]
            e, u = np.linalg.eigh(yy - c.T @ inside)
            ok = e > 1e-16
            turn = u[:, ok] / np.sqrt(e[ok])
            both = matrix_column(lambda x, k=keep, b=-inside @ turn, r=turn: x[:, :k] @ b + x[:, k:] @ r, F.concat("v", "av"))
            basis = basis.withColumn("v", F.concat("v", both))
            done, tall = keep, keep + int(ok.sum())
    count = min(count, len(values))
    if (residual[:count] >= tol).any():
        warnings.warn(f"eigenvectors did not converge in {cycles} cycles: residual {residual[:count].max():.1e}", stacklevel=2)
    pick = coef[:, :count]
    vectors = basis.select("i", matrix_column(lambda x: x[:, :len(pick)] @ pick, "v").alias("vector"))
    flip = _signs(vectors, count)
    return values[:count], cut_lineage(vectors.withColumn("vector", matrix_column(lambda x: x * flip, "vector")))


def _signs(df: DataFrame, count: int, vec: str = "vector") -> np.ndarray:
    """-1 for each component whose largest entry by size is negative."""
    at = df.agg(*[F.max_by(F.signum(F.col(vec)[c]), F.abs(F.col(vec)[c])).alias(f"s{c}") for c in range(count)]).first()
    return np.array([-1.0 if (at[c] or 1) < 0 else 1.0 for c in range(count)])


# ---- spectral embedding --------------------------------------------------------------------------

def adjacency(edges: DataFrame) -> DataFrame:
    """(i, j, w): half of an edge's weight for each direction it is found in."""
    one = edges.select(F.col("key").alias("i"), F.col("neighbor").alias("j"))
    return one.unionByName(one.select(F.col("j").alias("i"), F.col("i").alias("j"))).groupBy("i", "j").agg((F.count("*") / 2).alias("w"))


def normalised_adjacency(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((i, j, w / sqrt(d_i d_j)), (i, degree)); the normalised Laplacian is one minus the first."""
    w = cut_lineage(adjacency(edges))
    degree = cut_lineage(nodes.join(w.groupBy("i").agg(F.sum("w").alias("degree"), F.count("*").alias("weight")), "i", "left").select(
        "i", F.coalesce("degree", F.lit(0.0)).alias("degree"), F.coalesce("weight", F.lit(0)).alias("weight")))
    total = w.count()
    left = degree.select("i", F.col("degree").alias("di"), "weight")
    right = degree.select(F.col("i").alias("j"), F.col("degree").alias("dj"), "weight")
    scaled = join_groups(join_groups(w, left, "i", "weight", total), right, "j", "weight", total)
    return cut_lineage(scaled.select("i", "j", (F.col("w") / F.sqrt(F.col("di") * F.col("dj"))).alias("w"))), degree


def spectral_embedding(df: DataFrame, key: str, vec: str, components: int = 2, neighbors: int = 14,
                       tol: float = 1e-6) -> tuple[np.ndarray, DataFrame]:
    """(Laplacian eigenvalues, (key, embedding)): the smallest eigenvectors of the normalised graph
    Laplacian but the first, each divided by the root of the degree.

    ``neighbors`` counts other rows.  A graph in several parts has as many eigenvalues 0.
    """
    nodes = cut_lineage(df.select(F.col(key).cast("bigint").alias("i")))
    a, degree = normalised_adjacency(neighbor_edges(df, key, vec, neighbors), nodes)
    total = a.count()

    def product(x: DataFrame, width: int) -> DataFrame:
        known = x.join(degree.select("i", "weight"), "i").withColumnRenamed("i", "j")
        return sparse_product(a, known, width, total)

    values, vectors = largest_eigenvectors(product, nodes, components + 1, tol=tol)
    by_degree = F.when(F.col("degree") > 0, F.sqrt("degree")).otherwise(1.0)
    scaled = vectors.join(degree, "i").select("i", F.transform(F.slice("vector", 2, components), lambda v: v / by_degree).alias("z"))
    flip = _signs(scaled, components, "z")
    return 1 - values, scaled.select(F.col("i").alias(key), matrix_column(lambda x: x * flip, "z").alias("embedding"))


# ---- Isomap --------------------------------------------------------------------------------------

def connected_edges(edges: DataFrame, df: DataFrame, key: str, vec: str) -> DataFrame:
    """(i, j, distance) in both directions, with the shortest links between parts of the graph added."""
    from wideloom.operators.spanning import spanning_links

    both = cut_lineage(undirected(edges))
    points = df.select(F.col(key).cast("bigint").alias("i"), F.col(vec).alias("vec"))
    roots = cut_lineage(graph_components(both, points.select("i")))
    if roots.select("root").distinct().limit(2).count() < 2:
        return both
    links = spanning_links(points.join(roots, "i").select("i", "vec", "root")).select(
        F.col("u").alias("key"), F.col("v").alias("neighbor"), "distance")
    return cut_lineage(both.unionByName(undirected(links)))


def landmark_keys(nodes: DataFrame, m: int, seed: int = 42) -> list[int]:
    """Up to ``m`` nodes, the lowest by hash."""
    return [r["i"] for r in nodes.orderBy(F.xxhash64("i", F.lit(seed)), "i").limit(m).collect()]


def shortest_paths(edges: DataFrame, nodes: DataFrame, sources: Sequence[int], max_rounds: int = 10_000) -> DataFrame:
    """(i, paths): the length of the shortest path from every source, null where there is none.

    Many sources are relaxed at once; a round only sends on paths that became shorter in the last one,
    so it ends after as many rounds as the longest shortest path has edges.  The others travel as
    infinity, which takes next to no room once blocks are compressed.
    """
    m = len(sources)
    at = {s: c for c, s in enumerate(sources)}
    far = F.lit(float("inf"))
    degree = cut_lineage(edges.groupBy("j").agg(F.count("*").alias("weight")))
    total = edges.count()
    start = nodes.sparkSession.createDataFrame([(int(s), c) for s, c in at.items()], "i bigint, c int")
    state = cut_lineage(nodes.join(F.broadcast(start), "i", "left").select(
        "i", F.when(F.col("c").isNull(), F.array_repeat(far, m)).otherwise(
            F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda c: F.when(c == F.col("c"), 0.0).otherwise(far))).alias("paths"),
        F.col("c").isNotNull().alias("moved")).withColumn("fresh", F.transform("paths", lambda p: p < far)))
    for _ in range(max_rounds):
        sent = F.zip_with("paths", "fresh", lambda p, new: F.when(new, p).otherwise(far))
        front = state.where("moved").select(F.col("i").alias("j"), sent.alias("x")).join(degree, "j")
        found = join_groups(edges, front, "j", "weight", total, VECTORS).groupBy("i").agg(
            *[F.min(F.col("x")[c] + F.col("distance")).alias(f"y{c}") for c in range(m)])
        found = found.select(F.col("i").alias("_i"), F.array(*[f"y{c}" for c in range(m)]).alias("y"))
        nearer = F.zip_with("paths", "y", lambda p, q: F.least(p, q))
        shorter = F.coalesce(F.zip_with("paths", "y", lambda p, q: q < p), F.array_repeat(F.lit(False), m))
        state = cut_lineage(state.select("i", "paths").join(found, F.col("i") == F.col("_i"), "left").select(
            "i", F.when(F.col("y").isNull(), F.col("paths")).otherwise(nearer).alias("paths"), shorter.alias("fresh")).withColumn(
            "moved", F.exists("fresh", lambda b: b)))
        if state.where("moved").isEmpty():
            return state.select("i", F.transform("paths", lambda p: F.when(p < far, p)).alias("paths"))
    raise RuntimeError(f"paths did not settle in {max_rounds} rounds")


def landmark_scaling(between: np.ndarray, components: int) -> Callable[[np.ndarray], np.ndarray]:
    """Classical scaling of the landmarks' distances, as a function that places any row by its own
    distances to them; with every row a landmark it is classical scaling itself."""
    sq = between ** 2
    mean = sq.mean(axis=0)
    b = -0.5 * (sq - mean[:, None] - mean[None, :] + mean.mean())
    values, vectors = np.linalg.eigh((b + b.T) / 2)
    order = np.argsort(-values)[:components]
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    inverse = np.where(values > 1e-12 * max(values.max(initial=0.0), 1e-300), vectors / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return lambda paths: -0.5 * (paths ** 2 - mean) @ inverse


def isomap(df: DataFrame, key: str, vec: str, components: int = 2, neighbors: int = 5, max_landmarks: int = 128) -> DataFrame:
    """(key, embedding): scaling of the path lengths in the neighbour graph.

    ``max_landmarks`` rows stand for all in the scaling; with no more rows than that it is the full
    method.  Parts of the graph are linked by their shortest connections first.
    """
    edges = connected_edges(neighbor_edges(df, key, vec, neighbors), df, key, vec)
    nodes = df.select(F.col(key).cast("bigint").alias("i"))
    marks = landmark_keys(nodes, min(max_landmarks, MAX_LANDMARKS))
    paths = shortest_paths(edges, nodes, marks)
    own = {r["i"]: r["paths"] for r in paths.join(F.broadcast(nodes.sparkSession.createDataFrame(
        [(m,) for m in marks], "i bigint")), "i").collect()}
    between = np.array([own[m] for m in marks], float)
    place = landmark_scaling((between + between.T) / 2, components)
    return paths.select(F.col("i").alias(key), matrix_column(place, "paths").alias("embedding"))


# ---- locally linear embedding ----------------------------------------------------------------------

def _reconstruction(x: np.ndarray, near: np.ndarray, reg: float) -> np.ndarray:
    """Weights, adding up to 1, that rebuild each row from its neighbours: x is (rows, p), near (rows, k, p)."""
    z = near - x[:, None, :]
    c = z @ z.transpose(0, 2, 1)
    trace = np.trace(c, axis1=1, axis2=2)
    c += np.where(trace > 0, reg * trace, reg)[:, None, None] * np.eye(c.shape[1])
    w = np.linalg.solve(c, np.ones((len(c), c.shape[1], 1)))[:, :, 0]
    return w / w.sum(axis=1, keepdims=True)


def reconstruction_weights(edges: DataFrame, df: DataFrame, key: str, vec: str, reg: float = 1e-3) -> DataFrame:
    """(i, j, w): constrained least squares of every row on its neighbours in ``edges``."""
    points = cut_lineage(df.select(F.col(key).cast("bigint").alias("j"), F.col(vec).alias("x")))
    held = edges.groupBy(F.col("neighbor").alias("j")).agg(F.count("*").alias("weight"))
    met = join_groups(edges.select(F.col("key").alias("i"), F.col("neighbor").alias("j")), points.join(held, "j"), "j", "weight",
                      edges.count(), VECTORS)
    lists = met.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "x"))).alias("near"))  # k to a row
    rows = lists.join(points.select(F.col("j").alias("i"), F.col("x").alias("own")), "i").select(
        "i", "own", F.col("near.j").alias("js"), F.flatten("near.x").alias("flat"))

    @arrow_udf("array<double>")
    def solve(own: pa.Array, flat: pa.Array) -> pa.Array:
        if not len(own):
            return pa.array([], pa.list_(pa.float64()))
        x = to_complete_matrix(own)
        p = x.shape[1]
        size = np.diff(flat.offsets.to_numpy()) // p
        values = flat.flatten().to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(size * p)])
        out: list = [None] * len(x)
        for k in np.unique(size):  # rows with equally many neighbours in one call
            rows_k = np.flatnonzero(size == k)
            near = np.stack([values[at[r]:at[r + 1]].reshape(k, p) for r in rows_k])
            for r, w in zip(rows_k, _reconstruction(x[rows_k], near, reg)):
                out[r] = w
        return pa.array(out, pa.list_(pa.float64()))

    return rows.select("i", F.explode(F.arrays_zip("js", solve("own", "flat").alias("w"))).alias("e")).select(
        "i", F.col("e.js").alias("j"), F.col("e.w").alias("w"))


def _sparse_row(marks: np.ndarray, own: dict[bytes, int], z: int, reg: float):
    """Each row as weights of its ``z`` nearest landmarks; a landmark is itself."""

    def run(x: np.ndarray) -> np.ndarray:
        d = pair_distances(x, marks)
        at = np.argsort(d, axis=1, kind="stable")[:, :z]
        w = _reconstruction(x, marks[at], reg)
        for r, row in enumerate(np.ascontiguousarray(x)):
            mine = own.get(row.tobytes())
            if mine is not None:
                at[r], w[r] = mine, 0.0
                w[r, 0] = 1.0
        return np.concatenate([at.astype(float), w], axis=1)

    return run


def locally_linear_embedding(df: DataFrame, key: str, vec: str, components: int = 2, neighbors: int = 5, reg: float = 1e-3,
                             max_landmarks: int = MAX_LANDMARKS, landmark_neighbors: int | None = None) -> DataFrame:
    """(key, embedding): the smallest vectors but the first of the rows' reconstruction error.

    The embedding is sought among those that are linear in ``max_landmarks`` rows' places, each row
    being a combination of the nearest of them; with no more distinct rows than that it is the full
    method.  The error of such an embedding is a quadratic form of the landmarks' size, summed in
    one pass.  Rows of equal vectors share one place.
    """
    from wideloom.operators.dbscan import attach_ids, merge_copies

    points = cut_lineage(merge_copies(df.where(F.col(vec).isNotNull()), key, vec))
    rows, distinct = points.agg(F.sum("weight"), F.count("*")).first()
    single = points.select("id", "vec")
    w = cut_lineage(reconstruction_weights(neighbor_edges(single, "id", "vec", neighbors), single, "id", "vec", reg))
    marks = landmarks(single, "id", "vec", min(max_landmarks, MAX_LANDMARKS))
    z = min(len(marks), neighbors + 1 if landmark_neighbors is None else landmark_neighbors)
    m = len(marks)
    combine = _sparse_row(marks, {row.tobytes(): i for i, row in enumerate(np.ascontiguousarray(marks))}, z, reg)
    basis = cut_lineage(single.select(F.col("id").alias("j"), matrix_column(combine, "vec").alias("x")))
    # The rows of (I - W) B as lists of (landmark, coefficient), all of one length.
    error = w.select("i", "j", (-F.col("w")).alias("w")).unionByName(single.select(F.col("id").alias("i"), F.col("id").alias("j"), F.lit(1.0).alias("w")))
    degree = error.groupBy("j").agg(F.count("*").alias("weight"))
    met = join_groups(error, basis.join(degree, "j"), "j", "weight", distinct * (neighbors + 1), VECTORS)
    long = (neighbors + 1) * z
    parts = met.select("i", F.slice("x", 1, z).alias("at"), F.transform(F.slice("x", z + 1, z), lambda c: c * F.col("w")).alias("c"))
    pad = lambda c: F.slice(F.concat(F.flatten(F.collect_list(c)), F.array_repeat(F.lit(0.0), long)), 1, long).alias(c)
    lists = parts.groupBy("i").agg(pad("at"), pad("c"))

    def dense(at: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), m))
        np.add.at(out, (np.repeat(np.arange(len(at)), at.shape[1]), at.astype(int).ravel()), c.ravel())
        return out

    def square(at, c):
        total = np.zeros((m, m))
        for i in range(0, len(at), 1024):
            x = dense(at[i:i + 1024], c[i:i + 1024])
            total += x.T @ x
        return [total]

    form = sum_rows(lists, ["at", "c"], square, numbers=m * m)[0]
    mass, mean = sum_rows(basis, ["x"], lambda x: (square(x[:, :z], x[:, z:])[0], dense(x[:, :z], x[:, z:]).sum(0)), numbers=m * m + m)
    e, u = np.linalg.eigh(mass)
    keep = e > 1e-10 * e[-1]
    white = u[:, keep] / np.sqrt(e[keep])
    values, vectors = np.linalg.eigh(white.T @ form @ white)
    pick = white @ vectors[:, 1:components + 1]

    placed = basis.select(F.col("j").alias("i"), matrix_column(lambda x: dense(x[:, :z], x[:, z:]) @ pick, "x").alias("z"))
    flip = _signs(placed, pick.shape[1], "z")
    placed = placed.select(F.col("i").alias("id"), matrix_column(lambda x: x * flip, "z").alias("embedding"))
    ids = attach_ids(df, key, vec, points, rows, distinct)
    return ids.join(placed, "id").select(F.col("key").alias(key), "embedding")
