"""Shortest links: the minimum spanning tree of rows in many dimensions, and what follows from it.

Boruvka's rounds: every part of the forest but the largest takes its shortest link to another part, all
at once, so there are about log2(rows) rounds.  A row only looks as far as the shortest link its part knows of
already, which leaves few cells of the range join to visit.  Links compare by (distance, smaller key,
larger key), so equal distances make no cycle.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.joins import join_groups, measured_broadcast
from wideloom.functions.vectors import to_complete_matrix
from wideloom.operators.components import connected_components
from wideloom.operators.neighbors import BLOCK, FAR, Residents, block_join, pair_distances, tightened
from wideloom.operators.reduce import landmarks
from wideloom.session import cut_lineage

MAX_PIVOTS = 512


def _other_part(q: dict, d: Residents, tiles) -> dict | None:
    """Per part of the visitors its shortest link to a resident of another part, if one is within their radius."""
    roots, at = np.unique(q["root"], return_inverse=True)
    reach = np.full(len(roots), np.inf)  # the shortest link so far: longer ones do not count
    best: list[np.ndarray] = [np.zeros(0, int), np.zeros(0, int), np.zeros(0)]
    for tile, spans in tiles:
        mine = at[tile]
        limit = np.minimum(q["radius"][tile], reach[mine])
        for i, j, dist in d.close(q["vec"][tile], limit, spans, (q["root"][tile], d["root"])):
            if not len(i):
                continue
            x, y, w = (np.concatenate(c) for c in zip(best, (i + tile.start, j, dist)))
            u, v = q["key"][x], d["key"][y]
            order = np.lexsort((np.maximum(u, v), np.minimum(u, v), w, at[x]))
            first = order[np.unique(at[x][order], return_index=True)[1]]
            best = [x[first], y[first], w[first]]
            reach[at[best[0]]] = best[2]
            np.minimum(limit, reach[mine], out=limit)
    x, y, w = best
    return {"key": q["key"][x], "root": q["root"][x], "near": d["key"][y], "distance": w}


def _first_reach(marks: np.ndarray, roots: np.ndarray):
    """Distance of a row to the nearest landmark of another part (infinite if there is none)."""

    @arrow_udf("double")
    def run(x: pa.Array, root: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.float64())
        d = pair_distances(to_complete_matrix(x), marks)
        d[root.to_numpy()[:, None] == roots[None, :]] = np.inf
        return pa.array(d.min(axis=1))

    return run


def _shortest(points: DataFrame, rows: int, block: int) -> DataFrame:
    """(root, u, v, distance): the shortest link to another part of each part but the largest; ``points`` are
    (i, vec, root).  The others' links are in the tree as well, and their rows are all that has to search."""
    # Landmarks give every part a first bound; they are also the pivots of the join.
    marks = points.orderBy(F.xxhash64("i", F.lit(42)), "i").limit(min(MAX_PIVOTS, max(1, rows // block) + 32)).select("vec", "root").collect()
    where = np.array([r["vec"] for r in marks], float)
    pivots = where[:max(1, min(MAX_PIVOTS, rows // block))]
    bounds = points.withColumn("bound", _first_reach(where, np.array([r["root"] for r in marks], np.int64))("vec", "root"))
    least = bounds.groupBy("root").agg(F.min("bound").alias("least"), F.count("*").alias("weight"))
    largest = least.agg(F.max_by("root", F.struct("weight", -F.col("root")))).first()[0]
    reach = join_groups(points, least, "root", "weight", rows).withColumn(
        "least", F.when(F.col("least") < F.lit(1e300), F.col("least") * (1 + 1e-9)).otherwise(F.lit(1e300)))
    found = block_join(reach, "i", "vec", pivots, F.col("least"), _other_part, "key bigint, root bigint, near bigint, distance double",
                       ["root"], block=block, visits=F.col("root") != F.lit(largest))
    link = F.struct("distance", F.least("key", "near").alias("u"), F.greatest("key", "near").alias("v"))
    return found.groupBy("root").agg(F.min(link).alias("l")).select("root", "l.u", "l.v", "l.distance")


def spanning_links(points: DataFrame, block: int = BLOCK) -> DataFrame:
    """(u, v, distance): the shortest links that join all parts of ``points`` (i, vec, root) into one."""
    points = cut_lineage(points)
    rows = points.count()
    links = None
    while points.select("root").distinct().limit(2).count() > 1:
        new = cut_lineage(_shortest(points, rows, block))
        chosen = new.select("u", "v", "distance").distinct()
        links = chosen if links is None else links.unionByName(chosen)
        # Parts by their roots: the links, as edges between roots.
        home = points.select(F.col("i").alias("v"), F.col("root").alias("other"))
        far = new.select("root", F.explode(F.array("u", "v")).alias("v")).join(home, "v").where("other <> root")
        merged = connected_components(far.select(F.lit(0).alias("run"), F.col("root").alias("u"), F.col("other").alias("v")))
        sizes = points.groupBy("root").agg(F.count("*").alias("weight"))
        table = sizes.join(merged.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").withColumn(
            "to", F.coalesce("to", "root"))
        points = cut_lineage(join_groups(points, table, "root", "weight", rows).select("i", "vec", F.col("to").alias("root")))
        links = cut_lineage(links)
    if links is None:
        return points.sparkSession.createDataFrame([], "u bigint, v bigint, distance double")
    return links


def spanning_tree(df: DataFrame, key: str, vec: str, block: int = BLOCK) -> DataFrame:
    """(u, v, distance): the minimum spanning tree of the rows (distinct vectors, integer keys)."""
    k = F.col(key).cast("bigint")
    return spanning_links(df.select(k.alias("i"), F.col(vec).alias("vec"), k.alias("root")), block)


def _cut_tree(df: DataFrame, key: str, vec: str, points: DataFrame, tree: DataFrame, k: int | None, height: float | None, out: str
              ) -> DataFrame:
    """(key, cluster): what the links of a tree (u, v, distance) over ``points`` join, but for the k - 1 longest
    (ties: the ones of larger keys go first) or those longer than ``height``."""
    from wideloom.operators.dbscan import attach_ids
    from wideloom.operators.ranks import cumulative

    rows, distinct = points.agg(F.sum("weight"), F.count("*")).first()
    if height is not None:
        left = tree.where(F.col("distance") <= float(height))
    else:
        cut = tree.orderBy(F.desc("distance"), F.desc("u"), F.desc("v")).limit(min(k, distinct) - 1)
        left = tree.join(measured_broadcast(cut.select("u", "v")), ["u", "v"], "left_anti")
    roots = connected_components(left.select(F.lit(0).alias("run"), "u", "v"))
    home = points.select("id").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    numbers = cumulative(home.select("root").distinct(), [], "root", {"one": F.count("*")}).select(
        "root", F.col("before_one").cast("int").alias(out))
    ids = attach_ids(df, key, vec, points, rows, distinct)
    return ids.join(home, "id").join(numbers, "root").select(F.col("key").alias(key), out)


def single_linkage(df: DataFrame, key: str, vec: str, k: int | None = None, height: float | None = None, out: str = "cluster",
                   block: int = BLOCK) -> DataFrame:
    """(key, cluster): exact single-linkage clustering, numbered by the groups' smallest keys.

    The groups are what is left of the spanning tree without its k - 1 longest links (ties: the ones
    of larger keys go first), or without those longer than ``height``.  Rows of equal vectors are one
    point; rows without a vector are left out.
    """
    if (k is None) == (height is None):
        raise ValueError("give either a number of groups or a height")
    from wideloom.operators.dbscan import merge_copies

    points = cut_lineage(merge_copies(df.where(F.col(vec).isNotNull()), key, vec))
    tree = cut_lineage(spanning_tree(points, "id", "vec", block))
    return _cut_tree(df, key, vec, points, tree, k, height, out)


# ---- Ward's linkage ------------------------------------------------------------------------------------

def _ward(bounded: bool):
    """Per visitor the resident at the least Ward distance; ``bounded`` if the radius holds it."""

    def run(q: dict, d: Residents, tiles) -> dict | None:
        out = []
        for tile, spans in tiles:
            key, vec, m = q["key"][tile], q["vec"][tile], q["n"][tile]
            limit = q["radius"][tile] * (1 + 1e-9) + 1e-12 if bounded else np.full(len(key), FAR)
            least = np.sqrt(2 * m / (m + 1))  # no resident has fewer rows than one
            best: tuple = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
            near = tightened(vec, d, spans, limit.copy(), 1, (key, d["key"]))
            # Some resident is that near, and none has more rows than the largest.
            limit = np.where(limit >= FAR, np.where(near >= FAR, FAR, near * np.sqrt(2 * m * d["n"].max() / (m + d["n"].max())) / least), limit)
            for i, j, dist in d.close(vec, limit, spans, (key, d["key"])):
                if not len(i):
                    continue
                n = d["n"][j]
                i, j, w = (np.concatenate(c) for c in zip(best, (i, j, dist * np.sqrt(2 * m[i] * n / (m[i] + n)))))
                order = np.lexsort((d["key"][j], w, i))
                first = order[np.unique(i[order], return_index=True)[1]]
                best = i[first], j[first], w[first]
                limit[best[0]] = np.minimum(limit[best[0]], best[2] / least[best[0]] * (1 + 1e-9))
            i, j, _ = best
            n = d["n"][j]
            # Taken from the difference, a distance is the same from both ends.
            exact = np.sqrt(2 * m[i] * n / (m[i] + n) * ((vec[i] - d["vec"][j]) ** 2).sum(axis=1))
            out.append((key[i], d["key"][j], exact))
        return dict(zip(("key", "near", "distance"), map(np.concatenate, zip(*out)))) if out else None

    return run


FEW = 3072  # clusters that are merged on the driver: their matrix of distances has 75 MB
ONE_PASS = 1 << 16  # up to as many clusters all pairs are compared at once, without a first pass for bounds


def _merge_nearest(clusters: DataFrame, count: int, block: int) -> DataFrame:
    """(u, v, distance): the pairs of clusters that are each other's nearest by Ward distance."""
    schema = "key bigint, near bigint, distance double"
    if count <= ONE_PASS:
        pivots = np.zeros((1, len(clusters.first()["vec"])))
    else:
        pivots = landmarks(clusters, "id", "vec", max(1, min(MAX_PIVOTS, count // block)))
    link = F.min(F.struct("distance", F.least("key", "near").alias("u"), F.greatest("key", "near").alias("v"))).alias("l")
    found = block_join(clusters, "id", "vec", pivots, F.lit(0.0), _ward(False), schema, ["n"], home_only=True, block=block)
    if len(pivots) > 1:
        first = cut_lineage(found)
        # No cluster is smaller than one row, which bounds how far a nearer one can be.
        bound = first.groupBy(F.col("key").alias("_key")).agg(F.min("distance").alias("bound"))
        reach = clusters.join(bound, F.col("id") == F.col("_key"), "left").drop("_key").withColumn("reach", F.coalesce(
            F.col("bound") / F.sqrt(2 * F.col("n") / (F.col("n") + 1)) * (1 + 1e-9), F.lit(1e300)))
        found = block_join(reach, "id", "vec", pivots, F.col("reach"), _ward(True), schema, ["n"], block=block)
    best = found.groupBy("key").agg(link)
    return best.groupBy("l").agg(F.count("*").alias("ends")).where("ends = 2").select("l.u", "l.v", "l.distance")


def ward_linkage(df: DataFrame, key: str, vec: str, k: int, few: int = FEW, out: str = "cluster", block: int = BLOCK) -> DataFrame:
    """(key, cluster): exact Ward clustering into ``k`` groups, numbered by their smallest keys.

    Pairs of clusters that are each other's nearest merge, all at once, round by round; Ward's linkage is
    reducible, so the tree is that of one merge at a time.  The last ``few`` clusters, known by their
    sizes and means, are merged on the driver.  Rows of equal vectors start as one cluster.
    """
    from wideloom.operators.dbscan import merge_copies
    from wideloom.operators.hierarchy import merge_tree

    points = cut_lineage(merge_copies(df.where(F.col(vec).isNotNull()), key, vec))
    clusters = points.select("id", "vec", F.col("weight").cast("double").alias("n"))
    count, trees = clusters.count(), []
    while count > max(few, 1):
        links = cut_lineage(_merge_nearest(clusters, count, block))
        trees.append(links)
        if len(trees) == 16:
            trees = [cut_lineage(reduce(DataFrame.unionByName, trees))]
        group = clusters.join(links.select(F.col("v").alias("id"), F.col("u").alias("into")), "id", "left").withColumn(
            "into", F.coalesce("into", "id"))
        pairs = group.groupBy("into").agg(F.collect_list(F.struct("vec", "n")).alias("c"))  # two at most
        total = F.aggregate("c", F.lit(0.0), lambda s, e: s + e["n"])
        one, two = F.col("c")[0], F.get("c", F.lit(1))
        mean = F.when(two.isNull(), one["vec"]).otherwise(F.zip_with(
            one["vec"], two["vec"], lambda x, y: (x * one["n"] + y * two["n"]) / (one["n"] + two["n"])))
        clusters = cut_lineage(pairs.select(F.col("into").alias("id"), mean.alias("vec"), total.alias("n")))
        count = clusters.count()
    rows = clusters.orderBy("id").collect()  # ``few`` at most
    x, n = np.array([r["vec"] for r in rows], float), np.array([r["n"] for r in rows])
    last: list = []
    dist = pair_distances(x, x)
    for i in range(len(n)):
        dist[i] *= np.sqrt(2 * n[i] * n / (n[i] + n))
    merge_tree(dist, n, 1, "ward", last)
    rest = df.sparkSession.createDataFrame([(rows[i]["id"], rows[j]["id"], h) for i, j, h in last], "u bigint, v bigint, distance double")
    return _cut_tree(df, key, vec, points, reduce(DataFrame.unionByName, [*trees, rest]), k, None, out)
