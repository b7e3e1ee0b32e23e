"""Benchmark decontamination: CGK embedding, bit-sampling LSH over windows, exact verification.

Texts are sequences of words (lower-cased, cut at ASCII punctuation and white space).  An item is
found in a text when some run of its words is within ``max_edits`` (a share of the item's words)
word insertions, deletions and substitutions of the item.

The CGK walk (Chakraborty, Goldenberg, Koucky 2016) reads a window through random bits: at step s
it outputs the word under its pointer and moves on if bit(s, word) is set.  Small edit distance
becomes small Hamming distance of the outputs.  Bit sampling hashes a few random output positions
per table.  Walks and tables are repeated; their number follows from the target recall of one
window (a passage has several; the tests measure at least 0.9 for whole passages at the limit, in
each band of lengths).

Windows of texts start at every ``stride``-th word, windows of items at every word, so that an
exact passage always meets a window of its item.  Window lengths are powers of two; an item uses
the two largest that fit it.  Every hit is verified with the exact edit distance.

Windows of short items are too few for that.  An item below ``short`` words is cut into one piece
more than it may have edits: one of them is left whole in every passage, so looking for the pieces
at every word of a text finds all passages.

The items must be few enough for the tasks (``block`` at a time; a larger table takes one pass per
block); the documents are only read, nothing is shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import mix, prepared

_TO_SPACE = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_HITS = "array<struct<item:int,start:int,end:int,edits:int>>"


@dataclass(frozen=True)
class Search:
    max_edits: float = 0.2  # of the item's words
    recall: float = 0.6  # for one window with one edit; a passage has several windows
    stride: int = 8
    walks: int = 2
    samples: dict = field(default_factory=lambda: {2: 2, 4: 4, 8: 6, 16: 8, 32: 10, 64: 12, 128: 14})
    agreement: float = 0.75  # assumed share of equal outputs of such a window
    block: int = 2000
    short: int = 24  # items of fewer words are found by their pieces

    def tables(self, width: int) -> int:
        """Tables per walk: all walks together miss with probability 1 - recall."""
        hit = self.agreement ** self.samples[width]
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - hit) / self.walks))

    def widths(self, words: int) -> list[int]:
        if words < self.short:
            return []
        fit = [w for w in self.samples if w <= words - self.stride + 1]
        return [w for w in sorted(fit)[-2:] if w >= 8] or fit[-1:]

    def edits(self, words: int) -> int:
        return int(self.max_edits * words + 1e-9)

    def pieces(self, words: int) -> list[tuple[int, int]]:
        """(start, end) of the pieces of a short item: one more than its edits, about equal."""
        n = min(self.edits(words) + 1, words)
        return [(words * i // n, words * (i + 1) // n) for i in range(n)]


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def _codes(ws: list[bytes]) -> np.ndarray:
    return mix(np.fromiter(map(zlib.crc32, ws), np.uint64, len(ws)) + np.uint64(0x9E3779B97F4A7C15))


def _walk(x: np.ndarray, start: np.ndarray, steps: int, walk: int) -> list[np.ndarray]:
    """CGK outputs per step for windows of ``x`` (padded behind) from ``start``."""
    at, out = start.copy(), []
    odd = mix(np.arange(1, steps + 1, dtype=np.uint64) * np.uint64(2 * walk + 1)) | np.uint64(1)
    for s in range(steps):
        seen = x[at]
        out.append(seen)
        at = at + ((seen * odd[s]) >> np.uint64(63)).view(np.int64)
    return out


def _steps(width: int) -> int:
    return width + width // 2  # the pointer moves every other step: this stays inside the window


def _sampled(search: Search, width: int, walk: int, table: int) -> list[int]:
    rng = np.random.default_rng([width, walk, table])
    return sorted(rng.choice(_steps(width), min(search.samples[width], _steps(width)), replace=False).tolist())


def _keys(outputs: list[np.ndarray], picks: list[int], table_id: int) -> np.ndarray:
    odd = mix(np.arange(1, len(picks) + 1, dtype=np.uint64) * np.uint64(2 * table_id + 3)) | np.uint64(1)
    h = outputs[picks[0]] * odd[0]
    for p, o in zip(picks[1:], odd[1:]):
        h += outputs[p] * o
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def _grams(x: np.ndarray, n: int) -> np.ndarray:
    """Keys of the runs of ``n`` words."""
    return _keys([x[j:len(x) - n + 1 + j] for j in range(n)], list(range(n)), n)


def _bits(key: np.ndarray) -> np.ndarray:
    bits = np.zeros(1 << 17, bool)
    bits[key >> np.uint64(47)] = True
    return bits


def edit_search(item: list[bytes], text: list[bytes]) -> tuple[int, int]:
    """(least edit distance of ``item`` to a run of ``text``, first end of such a run).

    Bit-parallel (Myers 1999): one big-integer step per word of the text.
    """
    m = len(item)
    if not m:
        return 0, 0
    at: dict[bytes, int] = {}
    for i, w in enumerate(item):
        at[w] = at.get(w, 0) | (1 << i)
    top, full = 1 << (m - 1), (1 << m) - 1
    up, down, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text):
        eq = at.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        rise = down | ~(diagonal | up) & full
        fall = up & diagonal
        score += 1 if rise & top else -1 if fall & top else 0
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if score < best:
            best, end = score, j + 1
    return best, end


def locate(item: list[bytes], text: list[bytes], limit: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the first best run of ``text`` within ``limit`` edits of ``item``."""
    # Every kept word of the item is a word of the run: too few of them rule it out.
    if sum(map(set(item).__contains__, text)) < len(item) - limit:
        return None
    edits, end = edit_search(item, text)
    if edits > limit or not item or edits >= len(item):
        return None
    back, length = edit_search(item[::-1], text[:end][::-1])
    return end - length, end, edits


class Index:
    """Hash tables of a block of items; small and sent to every task."""

    def __init__(self, items: list[str | None], search: Search = Search()):
        self.search = search
        self.items = [words(t) for t in items]
        self.widths = sorted({w for x in self.items for w in search.widths(len(x))})
        self.seeds = self._seeds([i for i, x in enumerate(self.items) if x and not search.widths(len(x))])
        pad = np.zeros(max(self.widths, default=0) * 2 + 2, np.uint64)
        entries: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.tables = []
        for width in self.widths:
            use = [i for i, x in enumerate(self.items) if width in search.widths(len(x))]
            for walk in range(search.walks):
                found: dict[int, list] = {t: [] for t in range(search.tables(width))}
                for i in use:
                    starts = np.arange(len(self.items[i]) - width + 1)
                    out = _walk(np.concatenate([_codes(self.items[i]), pad]), starts, _steps(width), walk)
                    for t in found:
                        found[t].append((_keys(out, _sampled(search, width, walk, t), t), np.full(len(starts), i), starts))
                for t, parts in found.items():
                    key, item, start = (np.concatenate(c) for c in zip(*parts))
                    order = np.argsort(key, kind="stable")
                    self.tables.append((width, walk, _sampled(search, width, walk, t), t, key[order], item[order],
                                        start[order], _bits(key)))

    def _seeds(self, short: list[int]) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(words, sorted keys, item, start in the item, bits) per length of the pieces of short items."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i in short:
            x = _codes(self.items[i])
            for a, b in self.search.pieces(len(x)):
                found.setdefault(b - a, []).append((int(_grams(x[a:b], b - a)[0]), i, a))
        out = []
        for n, rows in sorted(found.items()):
            key = np.array([r[0] for r in rows], np.uint64)
            item, start = np.array([r[1:] for r in rows], np.int64).T
            order = np.argsort(key, kind="stable")
            out.append((n, key[order], item[order], start[order], _bits(key)))
        return out

    def seeded(self, x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Arrays (item, word position of a piece, position where the item would begin) for short items."""
        for n, key, item, start, bits in self.seeds:
            if len(x) < n:
                continue
            k = _grams(x, n)
            at = np.flatnonzero(bits[k >> np.uint64(47)])
            low, high = (np.searchsorted(key, k[at], side) for side in ("left", "right"))
            times = high - low
            at = np.repeat(at, times)
            e = np.repeat(low, times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            yield item[e], at, at - start[e]

    def candidates(self, x: np.ndarray, starts: np.ndarray) -> set[tuple[int, int]]:
        """(item, word position where the item would begin) of all table hits."""
        hits: set[tuple[int, int]] = set()
        if not self.widths or not len(starts):
            return hits
        x = np.concatenate([x, np.zeros(2 * self.widths[-1] + 2, np.uint64)])
        for walk in range(self.search.walks):
            out = _walk(x, starts, _steps(self.widths[-1]), walk)
            for width, w, picks, t, key, item, start, bits in self.tables:
                if w != walk:
                    continue
                k = _keys(out, picks, t)
                maybe = np.flatnonzero(bits[k >> np.uint64(47)])
                if not len(maybe):
                    continue
                k = k[maybe]
                low, high = np.searchsorted(key, k, "left"), np.searchsorted(key, k, "right")
                for q in np.flatnonzero(high > low):
                    for e in range(low[q], high[q]):
                        hits.add((int(item[e]), int(starts[maybe[q]] - start[e])))
        return hits

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text the best (item, start, end, edits) of every item found, in item order."""
        ws = [words(t) for t in texts]
        size = np.array([len(w) for w in ws], np.int64)
        base = np.concatenate([[0], np.cumsum(size)])
        x = _codes([w for one in ws for w in one])
        best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        starts = np.concatenate([np.arange(b, b + n, self.search.stride) for b, n in zip(base, size)] or [[]]).astype(np.int64)
        todo: dict[tuple[int, int], set[int]] = defaultdict(set)  # (text, item): where it would begin
        for at in range(0, len(starts), 16384):
            part = starts[at:at + 16384]
            last = int(part[-1]) + (2 * self.widths[-1] if self.widths else 0) + 2
            here = self.candidates(x[part[0]:last], part - part[0])
            for item, begin in here:
                begin += int(part[0])
                # A hit near a text's start may point before it: the window's own text counts.
                doc = int(np.searchsorted(base, max(begin, int(part[0])), "right")) - 1
                m = len(self.items[item])
                for d in {doc, int(np.searchsorted(base, min(begin + m - 1, len(x) - 1), "right")) - 1}:
                    todo[d, item].add(begin - int(base[d]))
        for item, at, begin in self.seeded(x):
            doc = np.searchsorted(base, at, "right") - 1
            for d, i, p in zip(doc.tolist(), item.tolist(), (begin - base[doc]).tolist()):
                todo[d, i].add(p)
        for (doc, item), begins in todo.items():
            m = len(self.items[item])
            limit = self.search.edits(m)
            places: list[list[int]] = []  # overlapping ones are searched as one
            for begin in sorted(begins):
                a, b = max(0, begin - limit), min(len(ws[doc]), begin + m + limit)
                if places and a <= places[-1][1]:
                    places[-1][1] = max(b, places[-1][1])
                elif a < b:
                    places.append([a, b])
            for a, b in places:
                got = locate(self.items[item], ws[doc][a:b], limit)
                if got:
                    one = (got[2], a + got[0], a + got[1])
                    best[doc][item] = min(best[doc].get(item, one), one)
        return [[(i, s, e, k) for i, (k, s, e) in sorted(found.items())] for found in best]


def benchmark_hits(items: list[str | None], text: str | Column = "text", search: Search = Search()) -> Column:
    """array<struct<item, start, end, edits>> of a text column; ``item`` is a position in ``items``,
    start and end are word positions.  Null and empty texts have no hits, items without a word
    are never found."""
    index = Index(items, search)

    def hits(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            texts = texts.tolist()
            for at in range(0, len(texts), 256):
                out += [[{"item": i, "start": s, "end": e, "edits": k} for i, s, e, k in one]
                        for one in index.find(texts[at:at + 256])]
            yield pd.Series(out, dtype=object)

    hits.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(hits, _HITS)(F.col(text) if isinstance(text, str) else text)


def _blocks(benchmark: DataFrame, key: str, text: str, size: int) -> Iterator[list[tuple[object, str | None]]]:
    """The items, a block at a time, in key order, so that neither driver nor tasks hold more."""
    items = benchmark.select(F.col(key).alias("k"), F.col(text).alias("t")).orderBy("k", "t")
    block: list = []
    for row in items.toLocalIterator():
        block.append((row["k"], row["t"]))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", search: Search = Search()) -> DataFrame:
    """(key, item key, start_word, end_word, edits): one row per row of ``docs`` and item found in it,
    with the item's best place (then its first).  An empty benchmark gives no rows."""
    spark = prepared(docs.sparkSession)
    kind = benchmark.schema[item_key].dataType.simpleString()
    out = None
    for block in _blocks(benchmark, item_key, item_text, search.block):
        keys = spark.createDataFrame([(i, k) for i, (k, _) in enumerate(block)], f"_item int, _item_key {kind}")
        found = (docs.select(F.col(key), benchmark_hits([t for _, t in block], text, search).alias("_hits"))
                 .select(key, F.explode("_hits").alias("_hit"))
                 .join(F.broadcast(keys), F.col("_hit.item") == F.col("_item"))
                 .select(key, F.col("_item_key").alias(item_key), F.col("_hit.start").alias("start_word"),
                         F.col("_hit.end").alias("end_word"), F.col("_hit.edits").alias("edits")))
        out = found if out is None else out.unionByName(found)
    if out is None:
        kinds = docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"`{key}` {kinds}, `{item_key}` {kind}, start_word int, end_word int, edits int")
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
                   item_text: str = "text", search: Search = Search()) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with the columns of ``docs``."""
    prepared(docs.sparkSession)
    for block in _blocks(benchmark, item_key, item_text, search.block):
        docs = docs.where(F.size(benchmark_hits([t for _, t in block], text, search)) == 0)
    return docs
