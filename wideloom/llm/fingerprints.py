"""Document fingerprints by locally consistent parsing.

A text is parsed in levels.  Runs of one symbol become one symbol; deterministic coin tossing (Cole
and Vishkin 1986) then relabels every symbol from itself and its left neighbour, three times, down
to a handful of labels without equal neighbours; phrases start at local maxima of the labels, and a
phrase's name is the hash of its content.  Names are the next level's symbols.  Where a phrase
starts only depends on a few symbols around it, so equal substrings get equal names in their
interior whatever their offset.

The fingerprint of a text is the bottom-k sketch of its names from level 3 on (phrases of roughly
30 characters and more, and always the whole text's); likeness is the Jaccard estimate of two
sketches.  All texts of a batch are parsed at once; phrases do not cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import mix, prepared, streamed_groups, whole_text

SKETCH = 64
FIRST_LEVEL = 3
LEVELS = 24
TOSSES = 3
PARSED = 64  # texts parsed at once: their symbols stay in the cache
_LOWEST = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)
_PLACES = mix(np.arange(1, 4097, dtype=np.uint64)) | np.uint64(1)


def _collapsed(sym: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol within a text become one symbol that knows its length."""
    new = np.ones(len(sym), bool)
    new[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(sym)))
    out = sym[at]
    long = size > 1
    out[long] = mix(out[long] ^ mix(size[long].astype(np.uint64)))
    return out, doc[at]


def _phrase_starts(sym: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Mask of the symbols that begin a phrase."""
    head = np.ones(len(sym), bool)
    head[1:] = doc[1:] != doc[:-1]
    # The first toss leaves labels below 128, so the others work on single bytes.
    other = sym[1:] ^ sym[:-1]
    place = np.bitwise_count((other & -other) - np.uint64(1))
    place[other == 0] = 0
    label = np.empty(len(sym), np.uint8)
    label[1:] = (place << 1) | ((sym[1:] >> place) & np.uint64(1)).astype(np.uint8)
    label[head] = (sym[head] & np.uint64(1)).astype(np.uint8)
    for _ in range(TOSSES - 1):
        place = _LOWEST[label[1:] ^ label[:-1]]
        tossed = np.empty_like(label)
        tossed[1:] = (place << 1) | ((label[1:] >> place) & 1)
        tossed[head] = label[head] & 1
        label = tossed
    top = head.copy()
    rise = label[1:] > label[:-1]
    top[1:-1] |= rise[:-1] & (label[1:-1] > label[2:]) & ~head[2:]
    return top


def phrase_names(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(names, index of their text) of all phrases from FIRST_LEVEL on."""
    size = np.array([len(t) for t in texts], np.int64)
    sym = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), size)
    sym = mix(sym + np.uint64(1))
    names, owners = [], []
    for level in range(1, LEVELS + 1):
        if not len(sym):
            break
        sym, doc = _collapsed(sym, doc)
        at = np.flatnonzero(_phrase_starts(sym, doc))
        length = np.diff(np.append(at, len(sym)))
        place = np.arange(len(sym)) - np.repeat(at, length)
        total = np.add.reduceat(sym * _PLACES[place % len(_PLACES)], at)
        sym, doc = mix(total + length.astype(np.uint64)), doc[at]
        if level >= FIRST_LEVEL:
            names.append(mix(sym + np.uint64(level)))
            owners.append(doc)
            more = np.bincount(doc, minlength=len(texts))[doc] > 1  # a text that is one phrase is done
            sym, doc = sym[more], doc[more]
    if not names:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(names), np.concatenate(owners)


def sketches(texts: list[str], k: int = SKETCH) -> list[np.ndarray]:
    """The ``k`` least distinct names of each text, shortened to 32 bits; none for an empty text."""
    names, owners = phrase_names(texts)
    short = (names >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((short, owners))
    short, owners = short[order], owners[order]
    new = np.ones(len(short), bool)
    new[1:] = (short[1:] != short[:-1]) | (owners[1:] != owners[:-1])
    short, owners = short[new], owners[new]
    cut = np.searchsorted(owners, np.arange(len(texts) + 1))
    return [short[a:min(b, a + k)] for a, b in zip(cut[:-1], cut[1:])]


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Jaccard estimate of two sketches: 1 for equal ones (two empty ones too), 0 against an empty one."""
    if np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    both = np.union1d(a, b)[:k]
    return float(np.isin(both, a).__and__(np.isin(both, b)).sum()) / len(both)


def fingerprint(text: str | Column = "text") -> Column:
    """Fingerprint string of a text column; null and empty texts have the empty string."""

    def prints(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            texts = texts.tolist()
            out: list[str] = []
            for at in range(0, len(texts), PARSED):
                out += [written(s) for s in sketches(texts[at:at + PARSED])]
            yield pd.Series(out, dtype=object)

    prints.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(prints, "string")(whole_text(text))


def with_next(docs: DataFrame, work, schema: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``work(keys, texts, next texts)`` over all rows, where the next text is that of the following
    key (of the first after the last).  Null keys come first; equal keys are ordered by text.

    Rows are dealt to key ranges and sorted within them; the first row of each range goes to the
    range before it as well, so the text is shuffled once and no range waits for another.  There
    are three ranges per shuffle partition, and as many first rows on the driver.
    """
    spark = prepared(docs.sparkSession)
    rows = docs.select(F.col(key).alias("k"), whole_text(text).alias("t"))
    many = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[key].dataType.simpleString()
    cuts = np.unique(rows.select("k").approxQuantile("k", [i / many for i in range(1, many)], 0.1 / many))

    def ranges(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for k in parts:
            x = k.to_numpy(np.float64, na_value=-np.inf)
            yield pd.Series(np.searchsorted(cuts, x, "right").astype(np.int32))

    ranges.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    bucket = F.pandas_udf(ranges, "int")(F.col("k"))
    dealt = rows.withColumn("bucket", bucket).withColumn("digest", F.md5(F.encode("t", "UTF-8")))
    order = F.struct(F.col("k").isNotNull().alias("some"), "k", "digest")
    firsts = sorted((r["bucket"], r["first"]) for r in
                    dealt.groupBy("bucket").agg(F.min(order).alias("first")).collect())
    ends = [(firsts[i - 1][0], firsts[i][1]["k"], firsts[i][1]["digest"]) for i in range(len(firsts))]
    if not ends:
        return spark.createDataFrame([], schema)
    ends = spark.createDataFrame(ends, f"before int, ek {kind}, ed string")
    own = dealt.select("bucket", "k", "t", "digest", F.lit(0).alias("tail"))
    tails = dealt.join(F.broadcast(ends), F.col("k").eqNullSafe(F.col("ek")) & (F.col("digest") == F.col("ed"))).select(
        F.col("before").alias("bucket"), "k", "t", "digest", F.lit(1).alias("tail"))

    def follow(batches):
        for _, parts in streamed_groups(batches, "bucket"):
            held: tuple = ()
            for part in parts:
                for at in range(0, part.num_rows, PARSED):
                    piece = part.slice(at, PARSED)
                    tail = piece.column("tail").to_pylist()
                    stop = tail.index(1) + 1 if 1 in tail else len(tail)
                    k, t = piece.column("k").to_pylist()[:stop], piece.column("t").to_pylist()[:stop]
                    if held:
                        k, t = [held[0], *k], [held[1], *t]
                    held = (k[-1], t[-1])
                    if len(k) > 1:
                        yield work(k[:-1], t[:-1], t[1:])
                    if stop < len(tail) or 1 in tail:
                        break
                else:
                    continue
                break

    shuffled = own.unionByName(tails).repartition(many, "bucket").sortWithinPartitions(
        "bucket", "tail", F.col("k").asc_nulls_first(), "digest")
    return shuffled.mapInArrow(follow, schema)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has its last half (rounded down) replaced by as much of the next text's start.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (f"`{key}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def work(keys, texts, nexts):
        edited = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in zip(texts, nexts)]
        own, changed = sketches([*texts, nexts[-1]]), sketches(edited)
        return pa.RecordBatch.from_arrays([
            pa.array(keys), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]),
            pa.array([written(s) for s in own[:-1]]), pa.array([written(s) for s in changed]),
            pa.array([likeness(a, b) for a, b in zip(own, changed)]),
            pa.array([likeness(a, b) for a, b in zip(own, own[1:])])],
            names=[key, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs, work, schema, key, text)
