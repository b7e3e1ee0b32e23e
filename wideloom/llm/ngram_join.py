"""N-gram Jaccard join: MinHash banding, then verification on the full n-gram sets.

Texts are lower-cased and split at white space; the set of a text is that of its runs of ``n``
words, or of its one shorter run.  Texts without a word are alike (similarity 1), null included,
and unlike all others.

1. One pass gives each row a 128-bit key of its set and its band hashes.  Rows with equal sets
   become one class (combined before the shuffle), so copies cost nothing further on.
2. Classes are shuffled on their band hashes.  Of buckets with the same members one is kept.
3. A bucket is cut into blocks of bounded size and bytes; a unit of work is a pair of blocks.  It
   holds the full sets, computes all overlaps at once, and counts a pair only in the first
   band that both share.  Units return link counts and spanning edges, never pairs.
4. Connected components of the edges are the groups.

Bands and rows come from the target recall: with ``rows`` rows a band of a pair at the threshold
agrees with probability ``threshold ** rows``, which fixes the number of bands.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import SubstringHashes, fresh, mix, prepared, signed, small, stored, streamed_groups, whole_text
from wideloom.operators.components import connected_components

BLOCK_ROWS = 1024
BLOCK_BYTES = 4 << 20


@dataclass(frozen=True)
class Banding:
    rows: int
    bands: int

    @staticmethod
    def choose(threshold: float, recall: float = 0.9999, rows: int = 5) -> Banding:
        """Fewest bands of ``rows`` rows that find a pair at the threshold with this probability."""
        return Banding(rows, math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows)))


def ngrams(text: str, n: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word runs of a text."""
    data = b" ".join(text.lower().encode("utf-8", "surrogatepass").split())
    if not data:
        return np.zeros(0, np.uint64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    start = np.concatenate([[0], gaps + 1])
    end = np.concatenate([gaps, [len(data)]])
    if len(start) > n:
        start, end = start[:len(start) - n + 1], end[n - 1:]
    else:
        start, end = start[:1], end[-1:]
    return np.unique(SubstringHashes(data).of(start, end))


def _coefficients(k: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix(np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:k] | np.uint64(1), x[k:]


def band_hashes(grams: np.ndarray, banding: Banding) -> np.ndarray:
    a, b = _coefficients(banding.rows * banding.bands)
    least = np.full(len(a), np.uint64(2**64 - 1))
    for at in range(0, len(grams), 1024):
        x = grams[at:at + 1024]
        x = x ^ (x >> np.uint64(32))
        np.minimum(least, ((a[:, None] * x[None, :]) + b[:, None]).min(axis=1), out=least)
    out = np.zeros(banding.bands, np.uint64)
    for r in range(banding.rows):
        out = mix(out * np.uint64(31) + least[r::banding.rows])
    return out


def _signatures(banding: Banding, n: int):
    def sign(batches):
        for batch in batches:
            keys, bands, sizes = [], [], []
            for t in batch.column("t").to_pylist():
                g = ngrams(t, n)
                keys.append(hashlib.blake2b(g.tobytes(), digest_size=16).digest())
                bands.append(signed(band_hashes(g, banding)) if len(g) else np.zeros(0, np.int64))
                sizes.append(len(g))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("digest"), pa.array(keys, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                names=["id", "digest", "node", "bands", "grams"])

    return sign


def _verify(n: int, threshold: float):
    def overlaps(sets: list[np.ndarray]) -> np.ndarray:
        """Sizes of all pairwise intersections, summed over slices of the shared n-grams."""
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        new = np.concatenate([[True], every[1:] != every[:-1]])
        column = np.cumsum(new) - 1
        shared = np.bincount(column)[column] > 1
        column, owner = column[shared], owner[shared]
        out = np.zeros((len(sets), len(sets)), np.float32)
        if not len(column):
            return out
        column = np.cumsum(np.concatenate([[0], (np.diff(column) > 0).astype(np.int64)]))
        width = max(256, min(4096, (8 << 20) // (4 * len(sets))))
        cut = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for a, b in zip(cut[:-1], cut[1:]):
            if a < b:
                part = np.zeros((len(sets), width), np.float32)
                part[owner[a:b], column[a:b] % width] = 1
                out += part @ part.T
        return out

    def unit(batches):
        for key, parts in streamed_groups(batches, "unit"):
            rows = pa.Table.from_batches(parts).to_pydict()
            band, i, j = key["band"], key["i"], key["j"]
            sets = [ngrams(t, n) for t in rows["t"]]
            size = np.array([len(s) for s in sets], np.float32)
            block = np.array(rows["block"])
            common = overlaps(sets)
            with np.errstate(divide="ignore", invalid="ignore"):
                alike = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-3
            if i != j:
                alike &= block[:, None] != block[None, :]
            np.fill_diagonal(alike, False)
            a, b = np.nonzero(np.triu(alike))
            if not len(a):
                continue
            bands = np.array(rows["bands"])
            first = np.empty(len(a), np.int64)
            for at in range(0, len(a), 65536):
                s = slice(at, at + 65536)
                first[s] = (bands[a[s]] == bands[b[s]]).argmax(axis=1)
            a, b = a[first == band], b[first == band]
            if not len(a):
                continue
            copies = np.array(rows["copies"])
            links = np.zeros(len(sets), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = list(range(len(sets)))
            for x, y in zip(a.tolist(), b.tolist()):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                while root[y] != y:
                    root[y] = root[root[y]]
                    y = root[y]
                root[max(x, y)] = min(x, y)
            for x in range(len(sets)):  # parents come first, so one step reaches the root
                root[x] = root[root[x]]
            on = np.flatnonzero(links).tolist()
            nodes = rows["node"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[x] for x in on], pa.binary()), pa.array([nodes[root[x]] for x in on], pa.binary()),
                 pa.array(links[on], pa.int64())], names=["node", "root", "links"])

    return unit


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
                    recall: float = 0.9999) -> DataFrame:
    """(key, digest, class_id, first_digest, n_links) for every row of ``docs``.

    ``class_id`` is the least key of the row's group: rows connected by links of similarity >=
    ``threshold`` (nulls last; ``first_digest`` is the MD5 of that row's text, ``digest`` of its
    own).  ``n_links`` counts the other rows linked to this one, copies included.  Repeated rows
    are copies of each other.  An empty table gives an empty result.
    """
    spark = prepared(docs.sparkSession)
    banding = Banding.choose(threshold, recall)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), whole_text(text).alias("t")).withColumn(
        "digest", F.unhex(F.md5(F.encode("t", "UTF-8"))))
    signed_rows = stored(rows.select("id", "digest", "t").mapInArrow(
        _signatures(banding, n), f"id {kind}, digest binary, node binary, bands array<bigint>, grams long"), "ngrams")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    classes = stored(signed_rows.groupBy("node").agg(
        F.min(order).alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands"),
        F.first("grams").alias("grams")), "ngram-classes")

    in_bands = classes.where("grams > 0").select(
        "node", "grams", F.posexplode("bands").alias("band", "value"))
    buckets = (in_bands.groupBy("band", "value")
               .agg(F.count("*").alias("members"), F.sum("grams").alias("size"),
                    F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("print")).where("members > 1"))
    kept = buckets.groupBy("members", "print").agg(F.min(F.struct("band", "value")).alias("b"), F.max("size").alias("size"))
    # An n-gram set takes 8 bytes an entry.
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("size") * 8 / BLOCK_BYTES)).cast("int")
    kept = kept.select("b.band", "b.value", blocks.alias("blocks"))
    members = stored(in_bands.join(kept, ["band", "value"]).select("node", "band", "value", "blocks"), "ngram-buckets")

    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", "bands", "copies", F.col("first.id").alias("id"), F.col("first.digest").alias("digest"))
    wanted = stored(wanted, "ngram-wanted")
    # The text of one row per class; fully repeated rows are combined before the shuffle.
    texts = (rows.join(small(wanted.select("node", "id", "digest")),
                       rows["id"].eqNullSafe(wanted["id"]) & (rows["digest"] == wanted["digest"]))
             .groupBy("node").agg(F.max("t").alias("t")))
    bodies = stored(texts.join(wanted.select("node", "bands", "copies"), "node"), "ngram-texts")

    block = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    units = (members.withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("node", "block", F.struct(
                 "band", "value", F.least("block", "other").alias("i"),
                 F.greatest("block", "other").alias("j")).alias("unit")))
    found = (units.join(bodies, "node").select("unit", "node", "block", "bands", "copies", "t")
             .repartition(F.col("unit")).sortWithinPartitions("unit", "node")
             .mapInArrow(_verify(n, threshold), "node binary, root binary, links long"))
    found = stored(found, "ngram-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.where("node != root").select(F.lit(0).alias("run"), F.col("node").alias("u"), F.col("root").alias("v"))
    roots = connected_components(edges.distinct()).select("node", "root")
    heads = (classes.join(roots, "node", "left").select(
        "node", "first", "copies", F.coalesce("root", "node").alias("root")))
    least = heads.groupBy("root").agg(F.min("first").alias("least"))
    table = (heads.join(least, "root").join(links, "node", "left")
             .select("node", F.col("least.id").alias("class_id"), F.col("least.digest").alias("first_digest"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (signed_rows.select("id", "digest", "node").join(table, "node")
            .select(F.col("id").alias(key), "digest", "class_id", "first_digest", "n_links"))


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8
                  ) -> DataFrame:
    """The rows of ``docs`` that lead their group, with the columns of ``docs``; repeated rows stay once."""
    found = near_duplicates(docs, key, text, n, threshold)
    leads = F.col(key).eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("first_digest"))
    found = stored(found.select(F.col(key).alias("key"), "digest", leads.alias("leads")), "ngram-groups")
    k, d = fresh(docs, "key"), fresh(docs, "digest")
    rows = docs.withColumn(d, F.unhex(F.md5(F.encode(whole_text(text), "UTF-8"))))

    def here(keys: DataFrame, how: str, left: DataFrame) -> DataFrame:
        keys = small(keys.select(F.col("key").alias(k), F.col("digest").alias(d)))
        return left.join(keys, left[key].eqNullSafe(keys[k]) & (left[d] == keys[d]), how)

    kept = here(found.where("not leads").distinct(), "left_anti", rows)
    again = found.where("leads").groupBy("key", "digest").count().where("count > 1")
    if again.isEmpty():
        return kept.drop(d)
    firsts = here(again, "left_semi", kept).groupBy(F.col(key).alias(k), d).agg(
        F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row")).select("row.*")
    return here(again, "left_anti", kept).drop(d).unionByName(firsts)
