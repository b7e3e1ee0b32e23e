"""Packing: best-fit decreasing of token pieces into fixed windows, at any scale.

Documents become token ids (a public byte-level BPE) and one end id each.  A document longer than
the window is first cut into full windows; what is left over is one shorter piece.

Best fit decreasing only depends on how many pieces have which length, and lengths are at most the
window: ``plan`` runs the whole algorithm on that histogram (``window`` numbers, whatever the size
of the corpus), taking equal pieces and equal windows together.  A segment tree indexed by
remaining capacity finds the tightest open windows.  The plan says where the pieces of rank
``a .. b`` of a length go; ranks are counted in the tasks, and each piece looks its place up.
"""

from __future__ import annotations

import base64
import functools
import json
import os
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wideloom.llm.common import prepared, small, whole_text

WINDOW = 1024


class CapacityTree:
    """Segment tree over remaining capacities 0..size; a leaf counts the open windows."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.total = [0] * (2 * self.leaves)

    def add(self, capacity: int, windows: int) -> None:
        node = self.leaves + capacity
        while node:
            self.total[node] += windows
            node //= 2

    def tightest(self, need: int) -> int | None:
        """The least capacity >= need that has an open window."""
        node = self.leaves + need
        if self.total[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.total[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.total[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


@dataclass
class Segment:
    """Pieces of ``size`` with ranks ``first .. first + per_window * windows - 1`` fill the windows
    ``window ..``, ``per_window`` in each, from ``offset``."""

    size: int
    first: int
    windows: int
    per_window: int
    window: int
    offset: int


def plan(counts: dict[int, int], window: int = WINDOW) -> list[Segment]:
    """Best fit decreasing of ``counts[length]`` pieces.

    Equal windows are kept as one group, so a group is split at most twice per length: there are
    at most about four groups per length and the list is bounded by the window, not by the pieces.
    """
    tree = CapacityTree(window)
    open_groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # capacity -> (first window, windows)
    out, made = [], 0

    def put(capacity: int, first: int, windows: int) -> None:
        if windows and capacity:
            open_groups[capacity].append((first, windows))
            tree.add(capacity, windows)

    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        while left:
            capacity = tree.tightest(size)
            if capacity is None:
                capacity, first, windows = window, made, -(-left // (window // size))
                made += windows
            else:
                first, windows = open_groups[capacity].pop()
                tree.add(capacity, -windows)
            per = capacity // size
            whole = min(windows, left // per)
            if whole:
                out.append(Segment(size, rank, whole, per, first, window - capacity))
                put(capacity - per * size, first, whole)
                left, rank = left - whole * per, rank + whole * per
            if whole < windows and left:  # fewer than ``per`` are left: they share one more window
                out.append(Segment(size, rank, 1, left, first + whole, window - capacity))
                put(capacity - left * size, first + whole, 1)
                whole, left = whole + 1, 0
            put(capacity, first + whole, windows - whole)
    return out


@functools.lru_cache(2)
def encoder(path: str):
    """Byte-pair encoder of the vocabulary at ``path`` (token bytes in base64, rank).

    It gives the ids of the same vocabulary's JSON form; the added tokens of that form are special.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(path))


def added_tokens(path: str) -> dict[str, int]:
    """Content and id of the added tokens in the JSON form beside the rank file, if there is one."""
    try:
        with open(os.path.splitext(path)[0] + ".json", encoding="utf-8") as f:
            added = json.load(f).get("added_tokens") or []
    except FileNotFoundError:
        return {}
    for t in added:
        if t.get("single_word") or t.get("lstrip") or t.get("rstrip"):
            raise ValueError(f"added token {t['content']!r} depends on the text around it")
    return {t["content"]: t["id"] for t in added}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_PIECES = "lane int, rank long, start long, length long, doc_tokens long, ids binary"


def token_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                 vocabulary: str | None = None, end_id: int = 0, added: bool = False) -> DataFrame:
    """(key, lane, rank, start, length, doc_tokens, ids): the pieces of all rows.

    ``ids`` are little-endian unsigned 32-bit; (lane, length, rank) counts equal lengths within a
    task.  Null and empty texts are one piece, the end id alone.  A repeated row is packed again.
    With ``added``, the added tokens of the vocabulary are single ids wherever a text has them, as its
    tokenizer does by default; without, they are ordinary text.
    """
    prepared(docs.sparkSession)
    path = vocabulary or default_vocabulary()
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches):
        encode = encoder(path).encode_ordinary
        if added:
            encode = functools.partial(encoder(path).encode, allowed_special="all", disallowed_special=())
        seen: dict[int, int] = defaultdict(int)
        lane = TaskContext.get().partitionId()
        for batch in batches:
            # A few hundred rows at a time, so that the ids of long texts do not pile up.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                who, ranks, starts, lengths, totals, ids = [], [], [], [], [], []
                for k, t in enumerate(part.column("t").to_pylist()):
                    got = np.array(encode(t) + [end_id], "<u4")
                    for start in range(0, len(got), window):
                        piece = got[start:start + window]
                        n = len(piece)
                        who.append(k)
                        ranks.append(seen[n])
                        seen[n] += 1
                        starts.append(start)
                        lengths.append(n)
                        totals.append(len(got))
                        ids.append(piece.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("k").take(pa.array(who)), pa.array([lane] * len(who), pa.int32()),
                     pa.array(ranks, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(totals, pa.int64()), pa.array(ids, pa.binary())],
                    names=[key, "lane", "rank", "start", "length", "doc_tokens", "ids"])

    return docs.select(F.col(key).alias("k"), whole_text(text).alias("t")).mapInArrow(cut, f"`{key}` {kind}, {_PIECES}")


def place(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """``pieces`` (stored: it is read twice) without lane and rank, plus sequence_id and offset.

    Ranks become global by adding, per length, the pieces of earlier lanes: a table of one row per
    lane and length.  The plan, bounded by the window, is broadcast.
    """
    spark = pieces.sparkSession
    lanes = pieces.groupBy("lane", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in lanes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = lanes.select("lane", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    ranked = (pieces.join(small(offsets), ["lane", "length"])
              .withColumn("_rank", F.col("rank") + F.col("_before")).drop("lane", "rank", "_before"))
    by_size: dict[int, list[Segment]] = defaultdict(list)
    for s in plan(counts, window):
        by_size[s.size].append(s)
    rows = [(size, [(s.first, s.windows, s.per_window, s.window, s.offset) for s in sorted(group, key=lambda s: s.first)])
            for size, group in by_size.items()]
    shape = "array<struct<first:bigint,windows:bigint,per:bigint,window:bigint,offset:bigint>>"
    segments = spark.createDataFrame(rows, f"length long, _plan {shape}")  # at most ``window`` rows
    hit = F.element_at(F.filter("_plan", lambda s: s["first"] <= F.col("_rank")), -1)
    at = F.col("_rank") - F.col("_hit.first")
    return (ranked.join(F.broadcast(segments), "length").withColumn("_hit", hit)
            .withColumn("sequence_id", F.col("_hit.window") + F.floor(at / F.col("_hit.per")))
            .withColumn("offset", F.col("_hit.offset") + (at % F.col("_hit.per")) * F.col("length"))
            .drop("_plan", "_hit", "_rank"))


def sequences(placed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, used): the packed windows from placed pieces that kept their ``ids``.

    A window is padded to ``window`` unless its used length is a power of two.
    """

    def fill(pieces):
        ids = np.frombuffer(b"".join(pieces["ids"][i] for i in np.argsort(pieces["offset"].to_numpy())), "<u4")
        used = len(ids)
        size = used if used & (used - 1) == 0 else window
        return pieces[["sequence_id"]].head(1).assign(
            ids=[np.concatenate([ids, np.full(size - used, pad_id, np.uint32)]).astype(np.int64)], used=used)

    return placed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInPandas(
        fill, "sequence_id long, ids array<bigint>, used long")


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
           vocabulary: str | None = None, added: bool = False) -> DataFrame:
    """(key, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    from wideloom.llm.common import stored

    pieces = token_pieces(docs, key, text, window, vocabulary, added=added)
    light = pieces.select(key, "lane", "rank", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return place(stored(light, "pieces"), window).select(
        key, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
