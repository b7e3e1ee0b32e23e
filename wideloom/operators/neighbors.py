"""Exact range and nearest-neighbour joins in many dimensions.

Rows are assigned to the cell of their nearest pivot.  For a row x of cell i, every point
of cell j is at least ``(d(x,p_j)^2 - d(x,p_i)^2) / (2 d(p_i,p_j))`` away, so x only meets
the cells this bound cannot rule out.  Cells are put together to parts of up to ``UNIT`` bytes of
vectors, and larger cells are hashed into several blocks.  A unit of work is a block of visitors
against a block of residents: a row travels once to each unit, however many cells it meets there, so
what is shuffled grows with the rows times the parts.  Inside a unit, tiles of visitors are compared
with pieces of residents by matrix products.  A unit returns summaries (counts, top-k, spanning
edges), never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.vectors import from_matrix, to_matrix
from wideloom.operators.reduce import landmarks
from wideloom.session import cores, cut_lineage

BLOCK = 2048  # rows of a cell, about
MAX_PIVOTS = 512
UNIT = 1 << 25  # bytes of vectors on one side of a unit
TILE, PIECE = 512, 8192  # visitors and residents compared at once
FAR = 1e300  # a radius without a bound


def pair_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    o = b.mean(axis=0)
    a, b = a - o, b - o
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T), 0))


def choose_pivots(df: DataFrame, key: str, vec: str, rows: int, block: int = BLOCK) -> np.ndarray:
    """About one pivot per block of rows; a broadcast of at most MAX_PIVOTS vectors."""
    return landmarks(df, key, vec, int(min(MAX_PIVOTS, max(1, rows // block))))


def _home(pivots: np.ndarray, vec: str | Column) -> Column:
    @arrow_udf("int")
    def run(x: pa.Array) -> pa.Array:
        return pa.array(pair_distances(to_matrix(x), pivots).argmin(axis=1).astype(np.int32)) if len(x) else \
            pa.array([], pa.int32())

    return run(vec)


def _met(x: np.ndarray, radius: np.ndarray, pivots: np.ndarray, between: np.ndarray) -> np.ndarray:
    """(rows x cells): the home cell and those that may hold a point within the row's radius."""
    d = pair_distances(x, pivots)
    home = d.argmin(axis=1)
    own = d[np.arange(len(d)), home]
    gap = between[home]
    bound = (d * d - (own * own)[:, None]) / np.where(gap > 0, 2 * gap, 1)
    bound = np.where(gap > 0, bound, 0.0)  # coinciding pivots rule nothing out
    hit = bound <= radius[:, None] * (1 + 1e-9) + 1e-12
    hit[np.arange(len(d)), home] = True
    return hit


def _reach(pivots: np.ndarray, part: np.ndarray, vec: str | Column, radius: Column) -> Column:
    """Parts with a cell that the row meets."""
    between = pair_distances(pivots, pivots)
    member = np.zeros((len(part), int(part.max()) + 1), np.float32)
    member[np.arange(len(part)), part] = 1

    @arrow_udf("array<int>")
    def run(x: pa.Array, r: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(pa.int32()))
        hit = _met(to_matrix(x), r.to_numpy(zero_copy_only=False), pivots, between).astype(np.float32) @ member > 0
        offsets = np.concatenate([[0], hit.sum(axis=1).cumsum()]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(hit)[1].astype(np.int32)))

    return run(vec, radius)


def _parts(pivots: np.ndarray, sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(part of each cell, blocks of each part): near cells together, up to ``rows`` rows; a part of one
    larger cell has several blocks."""
    between = pair_distances(pivots, pivots)
    part, blocks = np.zeros(len(pivots), int), []
    at, left, held = 0, np.ones(len(pivots), bool), 0
    while left.any():
        at = int(np.where(left, between[at], np.inf).argmin())
        left[at] = False
        if not blocks or held + sizes[at] > rows:
            blocks.append(max(1, -(-int(sizes[at]) // rows)))
            held = 0
        part[at], held = len(blocks) - 1, held + sizes[at]
    return part, np.array(blocks)


class Residents:
    """The residents of a unit, ready to be compared with tiles of visitors piece by piece."""

    def __init__(self, columns: dict[str, np.ndarray]):
        self.columns, self.vec = columns, columns["vec"]
        self.origin = self.vec.mean(axis=0)
        c = self.vec - self.origin
        norm = (c * c).sum(axis=1)
        self.far = float(np.sqrt(norm.max()))
        # (a, 1) . (b, -|b|^2 / 2) = (|a|^2 - d^2) / 2
        self.single = np.concatenate([c, -norm[:, None] / 2], axis=1).astype(np.float32) if 1e-15 < self.far < 1e15 else None

    def __getitem__(self, name: str) -> np.ndarray:
        return self.columns[name]

    @staticmethod
    def pieces(spans: Sequence[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        for lo, hi in spans:
            for at in range(lo, hi, PIECE):
                yield at, min(at + PIECE, hi)

    def close(self, a: np.ndarray, limit: np.ndarray, spans: Sequence[tuple[int, int]],
              apart: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, distance) of the pairs within ``limit``, one number per visitor, piece by piece.

        Limits may be lowered between pieces.  Pairs equal in ``apart`` (visitors' values, residents'
        values) are left out.  A product in single precision, with room for its rounding, finds the
        candidates; their distances are taken from the differences.
        """
        c = a - self.origin
        norm = (c * c).sum(axis=1)
        slack = (a.shape[1] + 8) * 2.0 ** -24 * (float(np.sqrt(norm.max())) + self.far) ** 2
        one = np.concatenate([c, np.ones((len(c), 1))], axis=1).astype(np.float32)
        for lo, hi in self.pieces(spans):
            square = np.minimum(limit, 1e18) ** 2
            screened = self.single is not None and slack <= 0.05 * np.median(square)
            if screened:
                low = (norm - square * (1 + 1e-9) - slack) / 2
                hit = one @ self.single[lo:hi].T >= (low - np.abs(low) * 1e-6).astype(np.float32)[:, None]
                screened = np.count_nonzero(hit) * 8 <= hit.size
            if not screened:
                dist = pair_distances(a, self.vec[lo:hi])
                hit = dist <= limit[:, None]
            i, j = np.divmod(np.flatnonzero(hit), hi - lo)
            if apart is not None:
                ok = apart[0][i] != apart[1][lo + j]
                i, j = i[ok], j[ok]
            if screened:
                d = np.empty(len(i))
                for at in range(0, len(i), 1 << 15):
                    s = slice(at, at + (1 << 15))
                    d[s] = np.sqrt(((a[i[s]] - self.vec[lo + j[s]]) ** 2).sum(axis=1))
                ok = d <= limit[i]
                yield i[ok], lo + j[ok], d[ok]
            else:
                yield i, lo + j, dist[i, j]


Spans = Sequence[tuple[int, int]]
Unit = Callable[[dict, Residents, Iterator[tuple[slice, Spans]]], "dict | None"]


def _tiles(q: dict, d: dict, pivots: np.ndarray, between: np.ndarray, home_only: bool) -> Iterator[tuple[slice, Spans]]:
    """Tiles of visitors (sorted by home cell) with the spans of residents they meet."""
    cells, first = np.unique(d["home"], return_index=True)
    last = np.append(first[1:], len(d["home"]))
    edge = np.append(np.flatnonzero(np.diff(q["home"])) + 1, len(q["home"]))
    at = 0
    while at < len(q["home"]):
        full = min(at + TILE, len(q["home"]))
        ends = edge[(edge >= at + TILE // 8) & (edge <= full)]  # rather whole cells
        end = int(ends[-1]) if len(ends) else full
        tile = slice(at, end)
        if home_only:
            met = np.isin(cells, q["home"][tile])
        elif len(pivots) == 1 or (q["radius"][tile] >= FAR).any():
            met = np.ones(len(cells), bool)
        else:
            met = _met(q["vec"][tile], q["radius"][tile], pivots, between).any(axis=0)[cells]
        spans: list[tuple[int, int]] = []
        for lo, hi in zip(first[met].tolist(), last[met].tolist()):
            if spans and spans[-1][1] == lo:
                spans[-1] = spans[-1][0], hi
            else:
                spans.append((lo, hi))
        if spans:
            yield tile, spans
        at = end


def unit_rows(df: DataFrame, rows: int, width: int, block: int) -> int:
    """Rows on one side of a unit: a few units per core, of bounded size."""
    share = -(-rows // math.isqrt(4 * cores(df.sparkSession) - 1)) if rows else 1
    return int(max(block, min(share, UNIT // (8 * width))))


def block_join(df: DataFrame, key: str, vec: str, pivots: np.ndarray, radius: Column, fn: Unit, schema: str,
               extra: Sequence[str] = (), home_only: bool = False, block: int = BLOCK, visits: Column | None = None
               ) -> DataFrame:
    """Run ``fn(visitors, residents, tiles)`` for every unit.  Both sides have ``key``, ``vec``, ``home``,
    ``radius`` and the extra columns as NumPy arrays; ``tiles`` are slices of the visitors with the spans
    of residents they meet.  The result is a dict of arrays (or None).  ``visits`` says which rows search."""
    if not len(pivots):  # no rows
        return df.sparkSession.createDataFrame([], schema)
    seeks = F.lit(True) if visits is None else visits
    base = df.select(F.col(key).alias("key"), F.col(vec).alias("vec"), *extra, radius.cast("double").alias("radius"),
                     seeks.alias("_seeks"))
    placed = base.withColumn("home", _home(pivots, F.col("vec")))
    sizes = np.zeros(len(pivots), int)
    for r in placed.groupBy("home").count().collect():
        sizes[r["home"]] = r["count"]
    per = unit_rows(df, int(sizes.sum()), pivots.shape[1], block)
    part, blocks = _parts(pivots, sizes, per)
    part_of = F.element_at(F.array(*[F.lit(int(p)) for p in part]), F.col("home") + 1)
    n_blocks = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("part") + 1)
    residents = placed.withColumn("part", part_of).withColumn("db", F.pmod(F.xxhash64("key"), n_blocks).cast("int"))
    visitors = placed.where("_seeks")
    if home_only or len(blocks) == 1:
        visitors = visitors.withColumn("part", part_of)
    else:
        visitors = visitors.withColumn("part", F.explode(_reach(pivots, part, F.col("vec"), F.col("radius"))))
    # Visitors of a part can outnumber its residents: size their blocks by their own count.
    v_sizes = np.zeros(len(blocks), int)
    if visits is None and (home_only or len(blocks) == 1):
        np.add.at(v_sizes, part, sizes)
    else:
        for r in visitors.groupBy("part").count().collect():
            v_sizes[r["part"]] = r["count"]
    v_blocks = -(-v_sizes // per)  # none where nobody comes
    n_visit = F.element_at(F.array(*[F.lit(int(b)) for b in v_blocks]), F.col("part") + 1)
    visitors = visitors.withColumn("qb", F.pmod(F.xxhash64("key"), n_visit).cast("int"))
    visitors = visitors.withColumn("db", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    residents = residents.withColumn("_n", n_visit).where("_n > 0").withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    cols = ["part", "qb", "db", "key", "vec", "home", "radius", *extra]
    both = visitors.select(*cols, F.lit(True).alias("visitor")).unionByName(
        residents.select(*cols, F.lit(False).alias("visitor")))
    names = ["key", "vec", "home", "radius", *extra]
    between = pair_distances(pivots, pivots)

    def unit(table: pa.Table) -> pa.Table:
        side = table.column("visitor").combine_chunks()
        halves = []
        for want in (True, False):
            half = table.filter(pa.compute.equal(side, want)).sort_by([("home", "ascending"), ("key", "ascending")])
            halves.append({n: _array(half.column(n)) for n in names})
        out = None
        if len(halves[0]["key"]) and len(halves[1]["key"]):
            out = fn(halves[0], Residents(halves[1]), _tiles(*halves, pivots, between, home_only))
        if out is None:
            return target.empty_table()
        return pa.table({f.name: _arrow(out[f.name], f.type) for f in target}, schema=target)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))
    return both.groupBy("part", "qb", "db").applyInArrow(unit, schema)


def _array(col) -> np.ndarray:
    if pa.types.is_list(col.type):
        kind = col.type.value_type
        if pa.types.is_floating(kind):
            return to_matrix(col)
        flat = col.combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(col), -1) if len(col) else flat.reshape(0, 0)
    return col.to_numpy()


def _arrow(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    if pa.types.is_list(kind):
        return from_matrix(values)
    return pa.array(values, type=kind)


def tightened(q: np.ndarray, d: Residents, spans: Spans, limit: np.ndarray, k: int, same: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Limits of rows that have none yet: the distance that k residents of the first piece keep to."""
    open_ = np.flatnonzero(limit >= FAR)
    lo, hi = next(d.pieces(spans))
    if not len(open_) or hi - lo < k:
        return limit
    dist = pair_distances(q[open_], d.vec[lo:hi])
    dist[same[0][open_][:, None] == same[1][lo:hi][None, :]] = np.inf
    found = np.partition(dist, k - 1, axis=1)[:, k - 1] if k > 1 else dist.min(axis=1)
    limit[open_] = np.where(np.isfinite(found), found * (1 + 1e-6) + 1e-6 * d.far, limit[open_])
    return limit


def top_k(k: int, bounded: bool) -> Unit:
    """The k nearest residents of other keys per visitor, ties by key; ``bounded`` if the radius holds them."""

    def run(q, d, tiles):
        out = []
        for tile, spans in tiles:
            key, vec = q["key"][tile], q["vec"][tile]
            limit = q["radius"][tile] * (1 + 1e-9) + 1e-12 if bounded else np.full(len(key), FAR)
            limit = tightened(vec, d, spans, limit, k, (key, d["key"]))
            best = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
            for found in d.close(vec, limit, spans, (key, d["key"])):
                if not len(found[0]):
                    continue
                i, j, dist = (np.concatenate(c) for c in zip(best, found))
                order = np.lexsort((d["key"][j], dist, i))
                i, j, dist = i[order], j[order], dist[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                ok = place < k
                best = i[ok], j[ok], dist[ok]
                last = place == k - 1
                limit[i[last]] = np.minimum(limit[i[last]], dist[last])
            out.append((key[best[0]], d["key"][best[1]], best[2]))
        return dict(zip(("key", "neighbor", "distance"), map(np.concatenate, zip(*out)))) if out else None

    return run


def nearest_neighbors(df: DataFrame, key: str, vec: str, k: int, rows: int | None = None, block: int = BLOCK
                      ) -> DataFrame:
    """Exact k nearest other rows of every row as (key, neighbor, distance).

    Round one searches the home cell and gives each row a radius; round two meets only
    the cells that radius reaches.
    """
    n = df.count() if rows is None else rows
    pivots = choose_pivots(df, key, vec, n, block)
    units = max(1, n // unit_rows(df, n, pivots.shape[1] if pivots.ndim > 1 else 1, block))
    schema = "key bigint, neighbor bigint, distance double"
    first = _best(block_join(df, key, vec, pivots, F.lit(0.0), top_k(k, False), schema, home_only=True, block=block), k, units)
    if len(pivots) == 1:
        return first
    radius = cut_lineage(first.groupBy("key").agg(F.count("*").alias("found"), F.max("distance").alias("far")))
    reach = df.select(F.col(key).alias("key"), F.col(vec).alias("vec")).join(radius, "key", "left").withColumn(
        "reach", F.when(F.col("found") >= k, F.col("far")).otherwise(F.lit(FAR)))
    return _best(block_join(reach, "key", "vec", pivots, F.col("reach"), top_k(k, True), schema, block=block), k, units)


def _best(candidates: DataFrame, k: int, units: int = 1) -> DataFrame:
    """The k nearest per key.  A key brings at most k candidates per unit it visited; when
    that can be many they are cut to k per salted part first."""
    def cut(df, *keys):
        lists = df.groupBy(*keys).agg(
            F.slice(F.array_sort(F.collect_list(F.struct("distance", "neighbor"))), 1, k).alias("best"))
        return lists.select("key", F.explode("best").alias("b")).select("key", "b.neighbor", "b.distance")

    if units > 64:
        salted = candidates.withColumn("salt", F.pmod(F.xxhash64("neighbor"), F.lit(math.isqrt(units))))
        candidates = cut(salted, "key", "salt")
    return cut(candidates, "key")
