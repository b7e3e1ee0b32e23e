"""DBSCAN for one or many (eps, min_samples) settings at once.

Equal vectors are first merged into one weighted point, so copies cost nothing.  One
blocked range join counts neighbours for every eps; a second one returns, per unit, only
a spanning forest of its core points and the few core neighbours of border points.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.functions.joins import join_groups
from wideloom.operators.components import connected_components
from wideloom.operators.neighbors import BLOCK, block_join, choose_pivots, nearest_neighbors
from wideloom.operators.quantiles import exact_quantiles
from wideloom.operators.ranks import cumulative
from wideloom.session import cut_lineage


def merge_copies(df: DataFrame, key: str, vec: str) -> DataFrame:
    """One row per distinct vector: (id = smallest key, vec, weight)."""
    return df.groupBy(F.col(vec).alias("vec")).agg(F.min(key).cast("bigint").alias("id"), F.count("*").alias("weight"))


def attach_ids(df: DataFrame, key: str, vec: str, points: DataFrame, rows: int, distinct: int) -> DataFrame:
    """(key, id) for every row; a vector held by many rows is matched by broadcast."""
    mine = df.select(F.col(key).cast("bigint").alias("key"), F.col(vec).alias("vec"))
    if rows == distinct:
        return mine.select("key", F.col("key").alias("id"))
    return join_groups(mine, points.select("vec", "id", "weight"), "vec", "weight", rows, VECTORS).select("key", "id")


VECTORS = 10_000  # distinct vectors that may be broadcast


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, for edges between nodes 0 to n - 1."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        low = np.minimum(ra, rb)
        np.minimum.at(root, ra, low)
        np.minimum.at(root, rb, low)
        while (root[root] != root).any():
            root = root[root]
        ok = root[a] != root[b]
        a, b = a[ok], b[ok]
    return root


PAIRS = 1 << 21  # links between core points that a unit holds before it keeps a forest only


def dbscan_grid(df: DataFrame, key: str, vec: str, settings: Sequence[tuple[float, int]], block: int = BLOCK
                ) -> DataFrame:
    """(key, run, cluster) for every setting; run numbers the settings, noise is -1.

    A row counts itself as a neighbour; clusters are numbered by their smallest core key;
    a border row joins the lowest-numbered cluster that reaches it.
    """
    points = merge_copies(df, key, vec).persist()
    rows, distinct = points.agg(F.sum("weight"), F.count("*")).first()
    eps = sorted({float(e) for e, _ in settings})
    pivots = choose_pivots(points, "id", "vec", distinct, block)

    def count(q, d, tiles):
        steps, key, near = np.array(eps), [], []
        for tile, spans in tiles:
            m = len(q["key"][tile])
            total = np.zeros(m * len(eps))
            for i, j, dist in d.close(q["vec"][tile], np.full(m, eps[-1]), spans):
                total += np.bincount(i * len(eps) + np.searchsorted(steps, dist), d["weight"][j], len(total))
            key.append(q["key"][tile])
            near.append(total.reshape(m, -1).cumsum(axis=1))
        return {"key": np.concatenate(key), "near": np.concatenate(near)} if key else None

    counted = block_join(points, "id", "vec", pivots, F.lit(eps[-1]), count, "key bigint, near array<double>",
                         ["weight"], block=block)
    totals = counted.groupBy("key").agg(*[F.sum(F.col("near")[i]).alias(f"n{i}") for i in range(len(eps))])
    is_core = F.array(*[(F.col(f"n{eps.index(float(e))}") >= m) for e, m in settings])
    points2 = points.join(totals.withColumnRenamed("key", "id"), "id").select(
        "id", "vec", is_core.alias("core")).persist()

    def link(q, d, tiles):
        """Spanning forests of the unit's core points, and the core neighbours of its border points."""
        n = len(d["key"])
        cq, cd = q["core"].astype(bool), d["core"].astype(bool)
        keys = np.concatenate([d["key"], q["key"]])
        held: list[list] = [[] for _ in settings]
        border: list[list] = [[] for _ in settings]

        def thin(s):
            root = _forest(len(keys), *map(np.concatenate, zip(*held[s])))
            node = np.flatnonzero(root != np.arange(len(root)))
            held[s] = [(node, root[node])]

        for tile, spans in tiles:
            for i, j, dist in d.close(q["vec"][tile], np.full(tile.stop - tile.start, eps[-1]), spans):
                i = i + tile.start
                for s, (e, _) in enumerate(settings):
                    ok = cd[j, s] & (dist <= e)
                    core = ok & cq[i, s]
                    held[s].append((n + i[core], j[core]))
                    edge = ok & ~cq[i, s]
                    border[s].append((q["key"][i[edge]], d["key"][j[edge]]))
                    if sum(len(x[0]) for x in held[s]) > PAIRS:
                        thin(s)
        run, u, v, kind = [], [], [], []
        for s in range(len(settings)):
            if held[s]:
                thin(s)
            pairs = [(*(keys[x] for x in p), 1) for p in held[s]] + [(*p, 0) for p in border[s]]
            for us, vs, k in pairs:
                ok = us != vs
                run.append(np.full(ok.sum(), s, np.int32))
                u.append(us[ok])
                v.append(vs[ok])
                kind.append(np.full(ok.sum(), k, np.int32))
        if not run:
            return None
        return {"run": np.concatenate(run), "u": np.concatenate(u), "v": np.concatenate(v),
                "core": np.concatenate(kind)}

    links = block_join(points2, "id", "vec", pivots, F.lit(eps[-1]), link,
                       "run int, u bigint, v bigint, core int", ["core"], block=block).persist()
    roots = connected_components(links.where("core = 1"))
    flags = points2.select("id", F.posexplode("core").alias("run", "is_core"))
    core = flags.where("is_core").join(
        roots.withColumnRenamed("node", "id"), ["run", "id"], "left").select(
        "run", "id", F.coalesce("root", "id").alias("root")).persist()
    border = links.where("core = 0").select("run", F.col("u").alias("id"), F.col("v").alias("near")).join(
        core.select("run", F.col("id").alias("near"), "root"), ["run", "near"]).groupBy("run", "id").agg(
        F.min("root").alias("root"))
    numbers = cumulative(core.select("run", F.col("root").cast("bigint")).distinct(), ["run"], "root",
                         {"one": F.count("*")}).select("run", "root", F.col("before_one").cast("int").alias("cluster"))
    labelled = core.unionByName(border).join(numbers, ["run", "root"]).select("run", "id", "cluster")
    every = attach_ids(df, key, vec, points, rows, distinct).withColumn(
        "run", F.explode(F.sequence(F.lit(0), F.lit(len(settings) - 1))))
    result = cut_lineage(every.join(labelled, ["run", "id"], "left").select(
        "key", "run", F.coalesce("cluster", F.lit(-1)).alias("cluster")))
    for used in (points, points2, links, core):
        used.unpersist()
    return result


def dbscan(df: DataFrame, key: str, vec: str, eps: float, min_samples: int = 5, out: str = "cluster") -> DataFrame:
    """(key, cluster)."""
    return dbscan_grid(df, key, vec, [(eps, min_samples)]).select(
        F.col("key").alias(key), F.col("cluster").alias(out))


def eps_from_neighbors(df: DataFrame, key: str, vec: str, points: int = 10, low: float = 0.1, high: float = 0.9
                       ) -> list[float]:
    """Evenly spaced eps between two quantiles of the distance to the nearest other row."""
    d = nearest_neighbors(df, key, vec, 1).persist()
    n = d.count()
    # The order statistic at int(n * share), as an exact quantile position.
    probs = [min(int(n * s), n - 1) / max(n - 1, 1) for s in (low, high)]
    q = exact_quantiles(d, {"d": F.col("distance")}, probs, rows=n)["d"]
    d.unpersist()
    return [float(v) for v in np.linspace(q[0], q[1], points)]
