"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``nodes`` points on a ring of 64-bit hashes; a row belongs to the next point
clockwise of its own.  A shard takes rows up to its bound; what overflows continues clockwise to
the next point whose shard has room.  With ``slack`` 0 the bounds add up to the rows, so counts
are at most one apart; a larger slack moves fewer rows.

Which shard takes how many rows of which arc only depends on the rows per arc, a table of
``shards * nodes`` numbers.  ``assign`` plays the overflow on it; the rows, numbered within their
arc, look their place up.  Numbering splits every arc into groups of about the square root of the
row count, so that equal ring keys (copies of one text) never meet in one task.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wideloom.llm.common import mix, prepared, small, stored

NODES = 128


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """(points in ring order, their shards).  A shard's points do not depend on the others."""
    at = np.arange(shards * nodes, dtype=np.uint64)
    point = mix(mix(at // np.uint64(nodes) + np.uint64(1)) ^ (at % np.uint64(nodes) + np.uint64(1)))
    order = np.argsort(point, kind="stable")
    return point[order], (order // nodes).astype(int)


def bounds(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def assign(counts: dict[int, int], owners: np.ndarray, room: list[int]) -> dict[int, list[tuple[int, int, int]]]:
    """Per arc the runs (first rank, shard, first slot) of its rows, in rank order.

    Each shard first takes of its own arcs, in ring order; the rest of an arc moves on to the next
    point with room, again in ring order.  A step splits at most one run, so there are at most as
    many runs as arcs and shards allow, whatever the number of rows.
    """
    room, load = list(room), [0] * len(room)
    out: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    waiting = [(arc, 0, n, arc) for arc, n in sorted(counts.items())]
    while waiting:
        over = []
        for arc, first, last, at in waiting:
            shard = int(owners[at])
            take = min(room[shard], last - first)
            if take:
                out[arc].append((first, shard, load[shard]))
                room[shard] -= take
                load[shard] += take
            if first + take < last:
                steps = range(1, len(owners) + 1)
                over.append((arc, first + take, last, next(
                    (at + k) % len(owners) for k in steps if room[owners[(at + k) % len(owners)]])))
        waiting = over
    return dict(out)


def arc_of(key: Column, points: np.ndarray) -> Column:
    """Index of the next point clockwise for a column of signed 64-bit hashes."""

    def arcs(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for h in parts:
            at = np.searchsorted(points, h.to_numpy(np.int64).view(np.uint64))
            yield pd.Series((at % len(points)).astype(np.int32))

    arcs.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(arcs, "int")(key)


def sharded(rows: DataFrame, ring_key: Column, order: list[str], shards: int, nodes: int = NODES,
            slack: float = 0.0) -> DataFrame:
    """The rows (few and short columns: they are stored once) with ``shard`` and ``slot``, gapless
    per shard.

    ``ring_key`` is hashed to the ring (null like any value); ``order`` breaks ties between rows of
    an arc.  An empty table gives an empty result.  Rows equal in ``order`` are interchangeable.
    """
    spark = prepared(rows.sparkSession)
    points, owners = ring(shards, nodes)
    light = stored(rows.withColumn("_arc", arc_of(F.xxhash64(ring_key), points)), "ring")
    counts = {r["_arc"]: r["n"] for r in light.groupBy("_arc").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    runs = assign(counts, owners, bounds(total, shards, slack))
    group = max(256, math.isqrt(total))
    plan = spark.createDataFrame(
        [(arc, max(1, -(-n // group)), runs[arc]) for arc, n in counts.items()],
        "_arc int, _groups int, _runs array<struct<first:bigint,shard:int,slot:bigint>>")  # at most shards * nodes rows
    dealt = light.join(F.broadcast(plan.drop("_runs")), "_arc").withColumn(
        "_group", F.pmod(F.xxhash64(*order), F.col("_groups")).cast("int"))
    sizes = dealt.groupBy("_arc", "_group").agg(F.count("*").alias("n"))
    before = Window.partitionBy("_arc").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_arc", "_group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_arc", "_group").orderBy(*order)
    run = F.element_at(F.filter("_runs", lambda r: r["first"] <= F.col("_rank")), -1)
    return (dealt.withColumn("_in", F.row_number().over(within) - 1).join(small(offsets), ["_arc", "_group"])
            .withColumn("_rank", F.col("_before") + F.col("_in")).join(F.broadcast(plan.drop("_groups")), "_arc")
            .withColumn("_run", run).withColumn("shard", F.col("_run.shard"))
            .withColumn("slot", F.col("_run.slot") + F.col("_rank") - F.col("_run.first"))
            .drop("_arc", "_groups", "_group", "_in", "_before", "_rank", "_runs", "_run"))


def shard_documents(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", slack: float = 0.0
                    ) -> DataFrame:
    """(key, size, text_crc32, shard, slot) for every row: copies of a text share their ring point,
    so they stay together as long as their shard has room.  Null texts count as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key), (F.octet_length(body) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"), F.xxhash64(body).alias("_ring"))
    return sharded(rows, F.col("_ring"), [key, "text_crc32", "size"], shards, slack=slack).drop("_ring")
