"""Agglomerative clustering of rows, of features, and of co-association signatures; micro-clusters."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.functions.joins import measured_broadcast
from wideloom.functions.samples import long_share
from wideloom.functions.vectors import matrix_column
from wideloom.operators.kmeans import KMeansModel, Spec, fit_many
from wideloom.operators.reduce import Gram, gram
from wideloom.operators.rowsums import sum_rows
from wideloom.operators.spanning import FEW, single_linkage, ward_linkage

LINKAGES = ("single", "complete", "average", "ward")


def merge_tree(dist: np.ndarray, sizes: np.ndarray, k: int, linkage: str, merges: list | None = None) -> np.ndarray:
    """Cut to k groups on a small distance matrix (Lance-Williams updates).

    Starts are weighted by ``sizes``; ``ward`` expects Ward distances between the starts.
    Groups are numbered by their first member.  ``merges`` receives (first member, first member, height).
    """
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage {linkage!r}")
    m = len(dist)
    d = np.array(dist, float) ** (2 if linkage == "ward" else 1)
    np.fill_diagonal(d, np.inf)
    n, alive, group = np.array(sizes, float), np.ones(m, bool), np.arange(m)
    near, near_d = d.argmin(axis=1), d.min(axis=1)
    for _ in range(max(0, m - k)):
        i = int(np.where(alive, near_d, np.inf).argmin())
        j = int(near[i])
        i, j = min(i, j), max(i, j)
        if merges is not None:
            merges.append((i, j, float(d[i, j]) ** (0.5 if linkage == "ward" else 1.0)))
        a, b = d[i].copy(), d[j].copy()
        if linkage == "single":
            new = np.minimum(a, b)
        elif linkage == "complete":
            new = np.maximum(a, b)
        elif linkage == "average":
            new = (n[i] * a + n[j] * b) / (n[i] + n[j])
        else:
            new = ((n[i] + n) * a + (n[j] + n) * b - n * d[i, j]) / (n[i] + n[j] + n)
        alive[j] = False
        new[~alive] = np.inf
        new[i] = np.inf
        d[i], d[:, i] = new, new
        d[j], d[:, j] = np.inf, np.inf
        n[i] += n[j]
        group[group == j] = i
        near_d[j] = np.inf
        stale = alive & ((near == i) | (near == j))
        stale[i] = True
        for r in np.flatnonzero(stale):
            near[r], near_d[r] = d[r].argmin(), d[r].min()
        closer = alive & (d[:, i] < near_d)
        near[closer], near_d[closer] = i, d[closer, i]
    _, first = np.unique(group, return_index=True)
    order = {g: c for c, g in enumerate(group[np.sort(first)])}
    return np.array([order[g] for g in group])


def micro_clusters(df: DataFrame, key: str, vec: str, m: int, rounds: int = 300) -> tuple[KMeansModel, np.ndarray]:
    """At most ``m`` centers standing for all rows, with their sizes, in order of the
    smallest key they hold.

    One path at every size: ``m`` distinct rows (the lowest by hashed vector) start a k-means that
    runs to convergence.  With ``m`` distinct rows or fewer, each is its own center.
    """
    code = F.xxhash64(F.col(vec), F.lit(42))
    data = df.where(F.col(vec).isNotNull())
    guess = data.agg(F.approx_count_distinct(code, 0.02)).first()[0]
    cut = 1.2 * (m + 8 * m ** 0.5 + 16) / max(1, guess)
    few = data if cut >= 1 else data.where(long_share(code) < cut)
    rows = few.groupBy(F.col(vec).alias("v")).agg(F.min(code).alias("c")).orderBy("c", "v").limit(m).collect()
    start = np.array([r["v"] for r in rows], float)
    model = fit_many(df, key, vec, {"m": Spec(len(start), 1, init=start)}, rounds)["m"]
    size = sum_rows(df, [vec], lambda x: [np.bincount(model.distances(x).argmin(axis=1), minlength=len(model.centers)
                                                     ).astype(float)], numbers=len(model.centers))[0]
    keep = size > 0
    model.centers, size = model.centers[keep], size[keep]
    firsts = {r["j"]: r["k"] for r in df.select(model.column(vec).alias("j"), F.col(key).alias("k")).groupBy("j").agg(
        F.min("k").alias("k")).collect()}
    order = np.argsort([firsts.get(j, float("inf")) for j in range(len(size))], kind="stable")
    model.centers, size = model.centers[order], size[order]
    return model, size


def agglomerative(df: DataFrame, key: str, vec: str, k: int, linkage: str = "ward", max_micro: int = 512,
                  out: str = "cluster") -> DataFrame:
    """Agglomerative clustering, exact at any size: ``single`` by the spanning tree, the others by rounds of
    reciprocal nearest neighbours, which merge on the driver from ``max_micro`` or ``FEW`` clusters on,
    whichever is more.
    """
    if linkage in ("single", "ward"):
        if linkage == "single":
            labels = single_linkage(df, key, vec, k, out="_group")
        else:
            labels = ward_linkage(df, key, vec, k, max(max_micro, FEW), out="_group")
        labels = labels.withColumnRenamed(key, "_row")
        return df.join(labels, F.col(key) == F.col("_row")).withColumn(out, F.col("_group")).drop("_row", "_group")
    if linkage not in LINKAGES:
        raise ValueError(f"unknown linkage {linkage!r}")
    from wideloom.operators.linkage import pair_linkage

    return pair_linkage(df, key, vec, k, linkage, max(max_micro, FEW), out)


def _label_by_micro(df: DataFrame, vec: str, model: KMeansModel, labels: np.ndarray, out: str) -> DataFrame:
    table = F.array(*[F.lit(int(g)) for g in labels])
    return df.withColumn("_micro", model.column(vec)).withColumn(
        out, F.element_at(table, F.col("_micro") + 1)).drop("_micro")


# ---- features ---------------------------------------------------------------------------

def feature_groups(g: Gram, k: int, linkage: str = "ward") -> np.ndarray:
    """Group features by the distance between their columns, taken from the Gram matrix:
    |a - b|^2 = a.a + b.b - 2 a.b over all rows."""
    s = g.second_moment
    d = np.sqrt(np.maximum(np.diag(s)[:, None] + np.diag(s)[None, :] - 2 * s, 0))
    return merge_tree(d, np.ones(len(d)), k, linkage)


class FeatureAgglomeration:
    """Pools each feature group by its mean."""

    def __init__(self, groups: np.ndarray):
        self.groups = np.asarray(groups)
        k = int(self.groups.max()) + 1
        self.pool = np.stack([(self.groups == j) / (self.groups == j).sum() for j in range(k)], axis=1)

    def transform(self, df: DataFrame, vec: str, out: str) -> DataFrame:
        pool = self.pool
        return df.withColumn(out, matrix_column(lambda x: x @ pool, vec))


def feature_agglomeration(df: DataFrame, vec: str, k: int, linkage: str = "ward") -> FeatureAgglomeration:
    return FeatureAgglomeration(feature_groups(gram(df, vec), k, linkage))


# ---- ensembles ---------------------------------------------------------------------------

MAX_SIGNATURES = 4096  # signatures up to which the matrix of their distances is held


def signatures(df: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """Rows with equal label tuples have equal co-association rows: one row per tuple."""
    return df.groupBy(*labels).agg(F.count("*").alias("rows"), F.min(key).alias("first_key"))


def coassociation(sig: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted share of clusterings in which two signatures agree; noise never agrees."""
    same = (sig[:, None, :] == sig[None, :, :]) & (sig[:, None, :] != -1)
    return same @ (weights / weights.sum())


def signature_tree(sig: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """``merge_tree`` by average linkage on one minus the co-association, without its matrix.

    The mean distance of two groups is one minus the product of their shares of each label, so a group is a
    sparse vector of shares, a row of distances is a product with all of them, and memory grows with the
    signatures.
    """
    m = len(sig)
    codes, weight, wide = [], [], 0
    for c, w in enumerate(weights / weights.sum()):
        values, at = np.unique(sig[:, c], return_inverse=True)
        codes.append(np.where(sig[:, c] == -1, -1, at + wide))
        weight.append(np.full(len(values), w))
        wide += len(values)
    weight = np.concatenate(weight)
    held = []
    for row in np.stack(codes, axis=1):
        row = row[row >= 0]
        held.append((row, np.ones(len(row))))
    # Entries of all groups in one row after the other, gone groups with share 0.
    owner = np.repeat(np.arange(m), [len(c) for c, _ in held])
    code, share = np.concatenate([c for c, _ in held]), np.concatenate([s for _, s in held])

    n, alive, group = np.array(sizes, float), np.ones(m, bool), np.arange(m)

    def distances(r: int) -> np.ndarray:
        probe = np.zeros(wide)
        probe[held[r][0]] = held[r][1] * weight[held[r][0]]
        d = 1 - np.bincount(owner, share * probe[code], minlength=m)
        d[~alive] = np.inf
        d[r] = np.inf
        return d

    near, near_d = np.zeros(m, int), np.full(m, np.inf)
    for r in range(m):
        d = distances(r)
        near[r], near_d[r] = d.argmin(), d.min()
    for _ in range(max(0, m - k)):
        i = int(np.where(alive, near_d, np.inf).argmin())
        j = int(near[i])
        i, j = min(i, j), max(i, j)
        mine = np.zeros(wide)
        for g in (i, j):
            mine[held[g][0]] += n[g] / (n[i] + n[j]) * held[g][1]
        at = np.flatnonzero(mine)
        held[i], held[j] = (at, mine[at]), (at[:0], mine[:0])
        ok = (owner != i) & (owner != j)
        owner, code, share = (np.concatenate([x[ok], y]) for x, y in ((owner, np.full(len(at), i)), (code, at), (share, mine[at])))
        n[i] += n[j]
        alive[j] = False
        group[group == j] = i
        near_d[j] = np.inf
        stale = alive & ((near == i) | (near == j))
        stale[i] = False
        d = distances(i)
        near[i], near_d[i] = d.argmin(), d.min()
        for r in np.flatnonzero(stale):
            row = distances(r)
            near[r], near_d[r] = row.argmin(), row.min()
        closer = alive & (d < near_d)
        closer[i] = False
        near[closer], near_d[closer] = i, d[closer]
    _, first = np.unique(group, return_index=True)
    order = {g: c for c, g in enumerate(group[np.sort(first)])}
    return np.array([order[g] for g in group])


def ensemble(df: DataFrame, key: str, labels: Sequence[str], weights: dict[str, float], k: int,
             noise_limit: float = 0.5, noise_checked: Sequence[str] = ("dbscan",), out: str = "cluster") -> DataFrame:
    """Consensus of several labelings by average linkage on weighted co-association.

    A density clustering that calls more than half of the rows noise is left out.  Up to
    ``MAX_SIGNATURES`` distinct label tuples the driver holds the matrix of their distances, beyond it
    only the tuples; the linkage is the same.
    """
    labels = list(labels)
    checked = [c for c in labels if c in noise_checked]
    if checked:
        n, *bad = df.agg(F.count("*"), *[F.count_if(F.col(c) == -1) for c in checked]).first()
        labels = [c for c in labels if c not in checked or bad[checked.index(c)] <= noise_limit * n]
    if not labels:
        raise ValueError("no clustering left for the ensemble")
    sigs = signatures(df, key, labels)
    rows = sigs.orderBy("first_key").collect()
    table = np.array([[r[c] for c in labels] for r in rows])
    w, sizes = np.array([max(0.1, weights[c]) for c in labels]), np.array([r["rows"] for r in rows])
    groups = merge_tree(1 - coassociation(table, w), sizes, k, "average") if len(rows) <= MAX_SIGNATURES else \
        signature_tree(table, w, sizes, k)
    small = df.sparkSession.createDataFrame(
        [(*map(int, t), int(g)) for t, g in zip(table, groups)],
        ", ".join(f"`{c}` int" for c in labels) + f", `{out}` int")
    return df.join(measured_broadcast(small), labels)
