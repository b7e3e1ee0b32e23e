"""Exact average and complete linkage of any number of rows.

Rounds of reciprocal nearest neighbours, as for Ward's linkage: both linkages are reducible, so clusters that
are each other's nearest may merge all at once and the tree is that of one merge at a time.  A cluster's
nearest one stays so until one of the two merges; only the others search in a round.  The distance of two
clusters comes from all pairs of their rows, block against block, so a unit holds at most ``UNIT`` bytes of
vectors a side; its sums are of whole clusters, but for those with more rows than a block, whose sums of
several units are added up.  The driver holds a few numbers per distinct row, never vectors, until ``few``
clusters are left, whose matrix of distances it merges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.joins import join_groups
from wideloom.functions.vectors import to_complete_matrix
from wideloom.operators.dbscan import VECTORS, merge_copies
from wideloom.operators.neighbors import BLOCK, pair_distances, unit_rows
from wideloom.operators.rowsums import sum_rows
from wideloom.operators.spanning import FEW
from wideloom.session import cut_lineage

CELLS = 1 << 21  # distances at once
PAIRS = "grp bigint, near bigint, value double, whole boolean"


def looked_up(ids: np.ndarray, values: np.ndarray):
    """Column of the number that belongs to an id."""

    @arrow_udf("bigint")
    def run(x: pa.Array) -> pa.Array:
        return pa.array(values[np.searchsorted(ids, x.to_numpy())].astype(np.int64))

    return run


def numbered_points(df: DataFrame, key: str, vec: str) -> DataFrame:
    """(first, vec, n, id): distinct vectors with their smallest key and number of rows; ``id`` follows the key."""
    points = merge_copies(df, key, vec).select(F.col("id").alias("first"), "vec", F.col("weight").cast("double").alias("n"))
    return cut_lineage(points.orderBy(F.asc_nulls_last("first"), "vec").withColumn("id", F.monotonically_increasing_id()))


def _by_group(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(groups, where each begins, vectors, weights) of the rows sorted by group."""
    table = table.sort_by([("grp", "ascending"), ("id", "ascending")])
    groups, first = np.unique(table.column("grp").to_numpy(), return_index=True)
    return groups, first, to_complete_matrix(table.column("vec")), table.column("n").to_numpy()


def _group_distances(complete: bool, every: bool, wide: np.ndarray):
    """Per unit and visiting group the nearest other group of the unit, and what the unit has of its distance to
    each ``wide`` group (of every group, if it is one).  With ``every`` all distances to groups of larger number."""
    fold = np.maximum if complete else np.add

    def unit(table: pa.Table) -> pa.Table:
        side = table.column("visitor").combine_chunks()
        halves = [table.filter(side), table.filter(pa.compute.invert(side))]
        found: list = []
        if all(len(h) for h in halves):
            (gq, first_q, x, nq), (gd, first_d, y, nd) = map(_by_group, halves)
            many = np.isin(gd, wide)
            row_group = np.repeat(np.arange(len(gq)), np.diff([*first_q, len(x)]))
            size_q, size_d = np.add.reduceat(nq, first_q), np.add.reduceat(nd, first_d)

            def done(at: np.ndarray, value: np.ndarray) -> None:
                """All rows of the visiting groups ``at`` have met the unit's residents."""
                other = gq[at][:, None] != gd[None, :]
                split = many[None, :] | np.isin(gq[at], wide)[:, None]
                mean = value if complete else np.where(split, value, value / (size_q[at][:, None] * size_d))
                if every:
                    i, j = np.nonzero(gq[at][:, None] < gd[None, :])
                    found.append((gq[at][i], gd[j], mean[i, j], ~split[i, j]))
                    return
                i, j = np.nonzero(split & other)
                found.append((gq[at][i], gd[j], value[i, j], np.zeros(len(i), bool)))
                mean = np.where(split | ~other, np.inf, mean)
                j = mean.argmin(axis=1)  # the first of equal ones
                i = np.flatnonzero(np.isfinite(mean[np.arange(len(at)), j]))
                found.append((gq[at][i], gd[j[i]], mean[i, j[i]], np.ones(len(i), bool)))

            step = max(1, min(512, CELLS // len(y)))
            held: tuple | None = None  # a group that goes on in the next tile
            for a in range(0, len(x), step):
                part = slice(a, min(a + step, len(x)))
                dist = pair_distances(x[part], y)
                if not complete:
                    dist *= nd
                cols = fold.reduceat(dist, first_d, axis=1)
                if not complete:
                    cols *= nq[part][:, None]
                at, first = np.unique(row_group[part], return_index=True)
                value = fold.reduceat(cols, first, axis=0)
                if held is not None and held[0] == at[0]:
                    value[0] = fold(value[0], held[1])
                elif held is not None:
                    done(np.array([held[0]]), held[1][None])
                held = at[-1], value[-1]
                if len(at) > 1:
                    done(at[:-1], value[:-1])
            done(np.array([held[0]]), held[1][None])
        if not found:
            return _SCHEMA.empty_table()
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], schema=_SCHEMA)

    return unit


_SCHEMA = pa.schema([("grp", pa.int64()), ("near", pa.int64()), ("value", pa.float64()), ("whole", pa.bool_())])


def _met(points: DataFrame, ids: np.ndarray, group: np.ndarray, seeks: np.ndarray, complete: bool, every: bool, per: int) -> DataFrame:
    """Distances of the groups of the rows that seek to the others (see ``_group_distances``)."""
    groups, rows = np.unique(group, return_counts=True)
    wide = groups[rows > per]
    dealt_by = np.where(np.isin(group, wide), ids, group)  # rows of a wide group go to all blocks
    far, near = max(1, -(-len(ids) // per)), max(1, -(-int(seeks.sum()) // per))
    block = lambda n, salt: F.pmod(F.xxhash64(looked_up(ids, dealt_by)("id"), F.lit(salt)), F.lit(n)).cast("int")
    placed = points.select("id", "vec", "n", looked_up(ids, group)("id").alias("grp"))
    visitors = placed.where(looked_up(ids, seeks)("id") == 1).withColumn("qb", block(near, 1)).withColumn(
        "db", F.explode(F.sequence(F.lit(0), F.lit(far - 1))))
    residents = placed.withColumn("db", block(far, 2)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(near - 1))))
    cols = ["qb", "db", "id", "vec", "n", "grp"]
    both = visitors.select(*cols, F.lit(True).alias("visitor")).unionByName(residents.select(*cols, F.lit(False).alias("visitor")))
    return both.groupBy("qb", "db").applyInArrow(_group_distances(complete, every, wide), PAIRS)


def _search(points: DataFrame, ids: np.ndarray, group: np.ndarray, stale: np.ndarray, size: dict, complete: bool, per: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, its nearest one, distance) of the stale groups."""
    found = _met(points, ids, group, np.isin(group, stale), complete, False, per)
    whole = F.col("whole")
    if (np.unique(group, return_counts=True)[1] > per).any():
        # What several units have of a pair; the sizes of groups come from the driver.
        names, sizes = np.fromiter(size.keys(), np.int64, len(size)), np.fromiter(size.values(), np.float64, len(size))
        order = np.argsort(names)
        many = looked_up(names[order], sizes[order])  # numbers of rows
        parts = found.where(~whole).groupBy("grp", "near").agg((F.max if complete else F.sum)("value").alias("value"))
        found = found.where(whole).select("grp", "near", "value").unionByName(parts if complete else parts.select(
            "grp", "near", (F.col("value") / (many("grp") * many("near"))).alias("value")))
    best = found.groupBy("grp").agg(F.min(F.struct("value", "near")).alias("b")).select("grp", "b.near", "b.value").toArrow()
    return tuple(best.column(c).to_numpy() for c in ("grp", "near", "value"))


def _reciprocal(a: np.ndarray, b: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, distance), u < v: pairs that both ends prefer, by (distance, u, v), of what either end knows."""
    u, v = np.minimum(a, b), np.maximum(a, b)
    end = np.concatenate([u, v])
    u, v, value = (np.concatenate([c, c]) for c in (u, v, value))
    order = np.lexsort((v, u, value, end))
    first = order[np.unique(end[order], return_index=True)[1]]
    pair, at, ends = np.unique(np.stack([u[first], v[first]]), axis=1, return_index=True, return_counts=True)
    ok = ends == 2
    return pair[0][ok], pair[1][ok], value[first][at[ok]]


def pair_linkage(df: DataFrame, key: str, vec: str, k: int, linkage: str, few: int = FEW, out: str = "cluster", block: int = BLOCK
                 ) -> DataFrame:
    """``df`` with its clusters of exact ``average`` or ``complete`` linkage, numbered by their smallest keys.

    Rows of equal vectors start as one cluster.  Work grows with the square of the rows.
    """
    from wideloom.operators.hierarchy import merge_tree

    complete = linkage == "complete"
    total = sum_rows(df, [vec], lambda x: [np.array([float(len(x))])], numbers=1)[0][0]  # raises for incomplete vectors
    points = numbered_points(df, key, vec)
    known = points.select("id", "n").orderBy("id").toArrow()
    ids, weight = known.column("id").to_numpy(), known.column("n").to_numpy()
    per = unit_rows(df, len(ids), len(points.first()["vec"]), block)
    group = ids.copy()
    size, height = dict(zip(ids.tolist(), weight.tolist())), dict.fromkeys(ids.tolist(), 0.0)
    tree: list[tuple[int, int, float]] = []  # in an order in which children come before their parents
    best = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    stale = ids

    def merged(u: int, v: int, h: float) -> None:
        height[u] = max(h, height[u], height.pop(v))
        size[u] += size.pop(v)
        tree.append((u, v, height[u]))

    while len(size) > max(few, 1):
        new = _search(points, ids, group, stale, size, complete, per)
        best = [np.concatenate([x, y]) for x, y in zip(best, new)]
        u, v, value = _reciprocal(*best)
        for pair in zip(u.tolist(), v.tolist(), value.tolist()):
            merged(*pair)
        order = np.argsort(v)
        u, v = u[order], v[order]
        at = np.minimum(np.searchsorted(v, group), len(v) - 1)
        group = np.where(v[at] == group, u[at], group)
        gone = np.concatenate([u, v])
        keep = ~(np.isin(best[0], gone) | np.isin(best[1], gone))
        best = [x[keep] for x in best]
        stale = np.setdiff1d(np.unique(group), best[0])
    left = np.unique(group)
    m = len(left)
    count = np.array([size[g] for g in left.tolist()])
    if m == len(ids):
        x = np.array([r["vec"] for r in points.select("id", "vec").orderBy("id").collect()], float)
        dist = pair_distances(x, x)
    else:
        pairs = _met(points, ids, group, np.ones(len(ids), bool), complete, True, per).toArrow()
        i, j = (np.searchsorted(left, pairs.column(c).to_numpy()) for c in ("grp", "near"))
        value, part = pairs.column("value").to_numpy(), ~pairs.column("whole").to_numpy()
        dist = np.zeros((m, m))
        dist[i[~part], j[~part]] = value[~part]
        if complete:
            np.maximum.at(dist, (i[part], j[part]), value[part])
        else:
            np.add.at(dist, (i[part], j[part]), value[part] / (count[i[part]] * count[j[part]]))
        dist += dist.T
    last: list = []
    merge_tree(dist, count, 1, linkage, last)
    top = 0.0
    for i, j, h in last:
        top = max(top, h)
        merged(int(left[i]), int(left[j]), top)
    # The highest k - 1 merges are undone: of equal ones those that came last, parents before their children.
    high = np.array([h for _, _, h in tree])
    order = np.lexsort((np.arange(len(tree)), high))[:max(0, len(tree) - (k - 1))]
    kept = np.zeros(len(tree), bool)
    kept[order] = True
    root = dict(zip(ids.tolist(), ids.tolist()))
    for (u, v, _), ok in zip(reversed(tree), reversed(kept.tolist())):
        if ok:
            root[v] = root[u]
    roots = np.array([root[i] for i in ids.tolist()])
    labels = np.searchsorted(np.unique(roots), roots)
    named = points.select(F.col("vec").alias(vec), looked_up(ids, labels)("id").cast("int").alias("_group"), F.col("n").alias("weight"))
    return join_groups(df, named, vec, "weight", int(total), VECTORS).withColumn(out, F.col("_group")).drop("_group")
