"""Suffix-array dedup: bytes covered by a long string that also starts elsewhere.

Only the order of suffixes up to ``length`` bytes matters: a suffix is repeated when a neighbour in
its sorted bucket agrees with it that far.  The suffixes are sorted bucket by bucket, and a
difference cover keeps almost all of them out:

1. Cover sample.  A difference cover D modulo v holds, for any two positions, a shift below v that
   takes both into D.  So if equal strings of ``length`` bytes start at i and j, some sampled
   position of each names the same ``length - v + 1`` bytes.  One name per sampled position (18 of
   307 for 400 bytes) is shuffled; names seen twice mark the texts that can have repeats at all.
2. Buckets.  A suffix of a marked text goes to the bucket of the least k-gram in its first
   ``length`` bytes, which equal strings share.  Neighbouring suffixes of one bucket form a span.
   Long ties, spans of equal bytes, are resolved by their names, however many copies there are,
   and go on as one span.
3. Sorting.  Buckets with different spans are sorted one at a time, hashes of the ``length``-byte
   prefixes packed per span.  A bucket of many spans is split by hash, so a task holds a bounded
   piece of one bucket.
4. The starts found repeated become byte ranges of their text, which are cut out.

A text is known by its 128-bit digest; copies of a text are occurrences like any others.
Null texts count as empty; texts shorter than ``length`` and matches across texts do not occur.
Comparisons are by 64-bit hashes within a bucket of a 64-bit hash, and by 128-bit ones for spans.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wideloom.llm.common import SubstringHashes, prepared, run_hashes, signed, small, stored, streamed_groups, whole_text

SPANS_PER_TASK = 4096
BATCH_BYTES = 4 << 20


def difference_cover(limit: int) -> tuple[list[int], int]:
    """(D, v): the largest Singer difference set with v = q*q + q + 1 <= limit, q prime.

    Powers of an element of GF(q^3) whose highest coefficient is zero; the polynomial is searched.
    """
    for q in range(int(limit ** 0.5) + 1, 1, -1):
        v = q * q + q + 1
        if v > limit or any(q % p == 0 for p in range(2, q)):
            continue
        for a, b, c in ((a, b, c) for c in range(1, q) for b in range(q) for a in range(q)):
            x, found = (1, 0, 0), []
            for i in range(v):
                if x[2] == 0:
                    found.append(i)
                x = (x[2] * c % q, (x[0] + x[2] * b) % q, (x[1] + x[2] * a) % q)
            if len(found) == q + 1 and len({(s - t) % v for s in found for t in found}) == v:
                return found, v
    return [0], 1


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in linear time."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _runs(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _sample(length: int, cover: list[int], v: int):
    size = length - v + 1
    schema = pa.schema([("name", pa.int64()), ("tid", pa.int64()), ("sure", pa.bool_())])

    def flush(names: list[np.ndarray], tids: list[int]):
        every = np.concatenate(names)
        owner = np.repeat(np.array(tids, np.int64), [len(n) for n in names])
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        first = np.concatenate([[True], every[1:] != every[:-1]])
        many = (np.bincount(np.cumsum(first) - 1) > 1)[np.cumsum(first) - 1]
        # A name seen twice here marks its texts at once and goes on without them, as two rows; the marked
        # texts travel under their own hash.
        once, again = ~many, every[many & first]
        marked = np.unique(owner[many])
        name = np.concatenate([signed(every[once]), signed(np.repeat(again, 2)), marked])
        tid = np.concatenate([owner[once], np.zeros(2 * len(again), np.int64), marked])
        hidden, sure = np.zeros(len(name), bool), np.zeros(len(name), bool)
        hidden[once.sum():once.sum() + 2 * len(again)] = True
        sure[once.sum() + 2 * len(again):] = True
        return pa.RecordBatch.from_arrays([pa.array(name), pa.array(tid, mask=hidden), pa.array(sure)], schema=schema)

    def sample(batches):
        for batch in batches:
            names, tids, held = [], [], 0
            for t, tid in zip(batch.column("t").to_pylist(), batch.column("tid").to_pylist()):
                data = t.encode("utf-8")
                last = len(data) - size
                at = (np.arange(0, last + 1, v)[:, None] + np.array(cover)).ravel()
                at = at[at <= last]
                names.append(SubstringHashes(data).of(at, at + size))
                tids.append(tid)
                held += len(data)
                if held > BATCH_BYTES:
                    yield flush(names, tids)
                    names, tids, held = [], [], 0
            if names:
                yield flush(names, tids)

    return sample


_SPAN = "bucket long, hi long, lo long, digest binary, start long, starts long"


def _spans(length: int, k: int):
    def spans(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for t, digest in zip(batch.column("t").to_pylist(), batch.column("digest").to_pylist()):
                data = t.encode("utf-8")
                one, two = SubstringHashes(data), SubstringHashes(data, 1)
                prefix = one.windows(length)
                least = sliding_least(one.windows(k), length - k + 1)
                at = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
                count = np.diff(np.append(at, len(least)))
                end = at + count + length - 1
                order = np.argsort(prefix, kind="stable")
                same = np.flatnonzero(prefix[order[1:]] == prefix[order[:-1]])
                within = np.zeros(len(prefix), bool)
                within[order[same]] = within[order[same + 1]] = True
                a, b = _runs(within)
                cols[0] += [signed(least[at]), np.zeros(len(a), np.int64)]
                cols[1] += [signed(one.of(at, end)), np.zeros(len(a), np.int64)]
                cols[2] += [signed(two.of(at, end)), np.zeros(len(a), np.int64)]
                cols[3] += [digest] * (len(at) + len(a))
                cols[4] += [at, a]
                cols[5] += [count, a - b]  # negative: repeated within this text, no more to find out
                if len(cols[3]) > 50_000:
                    yield _batch(cols)
                    cols = [[] for _ in range(6)]
            if cols[3]:
                yield _batch(cols)

    return spans


def _batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(cols[0])), pa.array(np.concatenate(cols[1])), pa.array(np.concatenate(cols[2])),
         pa.array(cols[3], pa.binary()), pa.array(np.concatenate(cols[4]).astype(np.int64)),
         pa.array(np.concatenate(cols[5]).astype(np.int64))],
        names=["bucket", "hi", "lo", "digest", "start", "starts"])


_PACKED = "bucket long, part int, digest binary, known boolean, at binary, hashes binary"


def _packed(length: int):
    def pack(batches):
        seen: set[bytes] = set()
        for batch in batches:
            for digest, t, spans in zip(batch.column("digest").to_pylist(), batch.column("t").to_pylist(),
                                        batch.column("spans").to_pylist()):
                if digest in seen:  # another copy of a text that this task has had
                    continue
                seen.add(digest)
                prefix = SubstringHashes(t.encode("utf-8")).windows(length)
                out: list[list] = [[] for _ in range(6)]
                for s in spans:
                    at = np.arange(s["start"], s["start"] + s["starts"], dtype=np.int64)
                    h = prefix[at]
                    which = h % np.uint64(s["parts"])
                    for p in range(s["parts"]) if s["parts"] < 64 else np.unique(which).tolist():
                        on = which == p
                        if on.any():
                            for col, x in zip(out, (s["bucket"], p, digest, s["known"], at[on].astype("<i8").tobytes(),
                                                    h[on].tobytes())):
                                col.append(x)
                if out[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary()),
                         pa.array(out[3], pa.bool_()), pa.array(out[4], pa.binary()), pa.array(out[5], pa.binary())],
                        names=["bucket", "part", "digest", "known", "at", "hashes"])

    return pack


_FOUND = "digest binary, start long, stop long"


def _sorted_buckets(batches):
    """Repeated starts of one bucket (or one part of a large one) after another, as runs per span."""
    for _, parts in streamed_groups(batches, "unit"):
        rows = pa.Table.from_batches(parts).to_pydict()
        hashes = [np.frombuffer(x, np.uint64) for x in rows["hashes"]]
        every = np.concatenate(hashes)
        span = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        order = np.argsort(every, kind="stable")
        ranked = every[order]
        group = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))
        known = np.array(rows["known"], bool)[span[order]]
        # Rows of one text and place (a copy in another task) add nothing new but do no harm either.
        hit = (np.bincount(group) > 1) | (np.bincount(group, known) > 0)
        repeated = np.zeros(len(every), bool)
        repeated[order] = hit[group] & ~known
        digests, starts, stops = [], [], []
        at = 0
        for i, h in enumerate(hashes):
            on = repeated[at:at + len(h)]
            at += len(h)
            if on.any():
                place = np.frombuffer(rows["at"][i], "<i8")[on]
                gap = np.flatnonzero(np.diff(place) > 1)
                a, b = place[np.concatenate([[0], gap + 1])], place[np.concatenate([gap, [len(place) - 1]])] + 1
                digests += [rows["digest"][i]] * len(a)
                starts.append(a)
                stops.append(b)
        if digests:
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(np.concatenate(starts)),
                                              pa.array(np.concatenate(stops))], names=["digest", "start", "stop"])


def _cut(length: int):
    def cut(batches):
        seen: set[bytes] = set()
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for digest, t, found in zip(batch.column("digest").to_pylist(), batch.column("t").to_pylist(),
                                        batch.column("found").to_pylist()):
                if digest in seen:
                    continue
                seen.add(digest)
                data = t.encode("utf-8")
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, [f["start"] for f in found], 1)
                np.add.at(edge, [f["stop"] - 1 + length for f in found], -1)
                a, b = _runs(np.cumsum(edge[:-1]) > 0)
                kept = b"".join(data[x:y] for x, y in zip(np.concatenate([[0], b]), np.concatenate([a, [len(data)]])))
                for col, x in zip(out, (digest, int((b - a).sum()), list(map(int, a)), list(map(int, b)),
                                        hashlib.sha256(kept).hexdigest())):
                    col.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int64())),
                     pa.array(out[3], pa.list_(pa.int64())), pa.array(out[4])],
                    names=["digest", "n_removed", "starts", "stops", "kept_sha256"])

    return cut


def _passages(words: int, gram: int):
    """Winnowing: of every ``words - gram + 1`` consecutive grams of words the one of least hash, so that two
    texts with ``words`` equal consecutive words have a gram in common.  A row per text and gram."""

    def find(batches):
        for batch in batches:
            names, owners = [], []
            for t, tid in zip(batch.column("t").to_pylist(), batch.column("tid").to_pylist()):
                data = t.encode("utf-8")
                space = np.frombuffer(data, np.uint8) <= 32
                edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
                starts, ends = edge[::2], edge[1::2]
                if len(starts) < words:
                    continue
                # A gram's hash depends on its words alone, not on what is between them.
                grams = run_hashes(SubstringHashes(data).of(starts, ends), gram)
                least = np.unique(sliding_least(grams, words - gram + 1))
                names.append(signed(least))
                owners += [tid] * len(least)
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names)), pa.array(owners, pa.int64())], names=["name", "tid"])

    return find


def shared_passages(docs: DataFrame, text: str = "text", words: int = 51, gram: int = 41) -> DataFrame:
    """(tid): xxhash64 of the texts that share a passage with another row, copies included.

    Every text is found of which another row has ``words`` consecutive words, and none that shares
    fewer than ``gram``; in between the choice of grams decides.
    """
    prepared(docs.sparkSession)
    rows = docs.select(whole_text(text).alias("t")).select("t", F.xxhash64("t").alias("tid"))
    names = stored(rows.mapInArrow(_passages(words, gram), "name long, tid long"), "repeat-grams")
    twice = names.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    return names.join(twice, "name", "left_semi").select("tid").distinct()


def repeated_ranges(docs: DataFrame, text: str = "text", length: int = 400) -> DataFrame:
    """(digest, n_removed, starts, stops, kept_sha256) for each distinct text with repeats.

    ``digest`` is the MD5 of the text's UTF-8 bytes; starts and stops are the maximal removed byte
    ranges; the hash is that of the remaining bytes.
    """
    prepared(docs.sparkSession)
    cover, v = difference_cover(max(1, length * 4 // 5))
    k = max(1, min(32, length // 5))
    long = docs.select(whole_text(text).alias("t")).where(F.octet_length("t") >= length)

    # A name has at most two rows to a batch of texts here, so the window's groups stay small; one shuffle.
    names = long.select("t", F.xxhash64("t").alias("tid")).mapInArrow(_sample(length, cover, v), "name long, tid long, sure boolean")
    names = names.withColumn("n", F.count_if(~F.col("sure")).over(Window.partitionBy("name")))
    marked = names.where("tid is not null and (sure or n > 1)").select("tid").distinct()
    marked = stored(marked, "repeat-texts")
    digest = F.unhex(F.md5(F.encode("t", "UTF-8")))
    with_repeats = long.withColumn("tid", F.xxhash64("t")).join(small(marked, 1_000_000), "tid", "left_semi")
    spans = stored(with_repeats.select("t", digest.alias("digest")).mapInArrow(_spans(length, k), _SPAN), "repeat-spans")

    same = ["bucket", "hi", "lo", "starts"]
    ties = stored(spans.where("starts > 0").groupBy(*same).agg(
        F.count("*").alias("copies"), F.min(F.struct("digest", "start")).alias("first")), "repeat-ties")
    of_ties = spans.join(ties.where("copies > 1").select(*same), same).select(
        "digest", "start", (F.col("start") + F.col("starts")).alias("stop"))
    of_texts = spans.where("starts < 0").select("digest", "start", (F.col("start") - F.col("starts")).alias("stop"))

    open_buckets = ties.groupBy("bucket").agg(F.count("*").alias("spans")).where("spans > 1")
    todo = ties.join(open_buckets, "bucket").select(
        F.col("first.digest").alias("digest"), F.struct(
            "bucket", F.col("first.start").alias("start"), "starts", (F.col("copies") > 1).alias("known"),
            F.ceil(F.col("spans") / SPANS_PER_TASK).cast("int").alias("parts")).alias("span"))
    todo = stored(todo.groupBy("digest").agg(F.collect_list("span").alias("spans")), "repeat-todo")
    keyed = long.withColumn("digest", digest)
    chosen = keyed.join(small(todo.select("digest"), 1_000_000), "digest", "left_semi").join(todo, "digest")
    packed = chosen.select("digest", "t", "spans").mapInArrow(_packed(length), _PACKED)
    units = packed.withColumn("unit", F.struct("bucket", "part")).repartition("bucket", "part").sortWithinPartitions("unit")
    of_buckets = units.select("unit", "digest", "known", "at", "hashes").mapInArrow(_sorted_buckets, _FOUND)

    found = stored(of_buckets.unionByName(of_ties).unionByName(of_texts).distinct(), "repeat-found")
    ranges = found.groupBy("digest").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    touched = keyed.join(small(found.select("digest").distinct(), 1_000_000), "digest", "left_semi").join(ranges, "digest")
    done = touched.select("digest", "t", "found").mapInArrow(
        _cut(length), "digest binary, n_removed long, starts array<bigint>, stops array<bigint>, kept_sha256 string")
    return done.groupBy("digest").agg(*[F.first(c).alias(c) for c in ("n_removed", "starts", "stops", "kept_sha256")])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400) -> DataFrame:
    """(key, n_bytes, n_removed, starts, stops, kept_sha256, shares_passage) for every row of ``docs``.

    ``shares_passage`` tells whether more than 50 consecutive words are in another row too, which
    shorter passages than ``length`` bytes are not removed for (see ``shared_passages``).
    """
    body = F.encode(whole_text(text), "UTF-8")
    rows = docs.select(F.col(key), F.octet_length(body).cast("long").alias("n_bytes"), F.unhex(F.md5(body)).alias("digest"),
                       F.sha2(body, 256).alias("_sha"), F.xxhash64(whole_text(text)).alias("_tid"))
    found = stored(repeated_ranges(docs, text, length), "repeat-ranges")
    shared = stored(shared_passages(docs, text), "repeat-passages").select(F.col("tid").alias("_tid"), F.lit(True).alias("_shared"))
    none = F.array().cast("array<bigint>")
    return rows.join(found, "digest", "left").join(small(shared, 1_000_000), "_tid", "left").select(
        key, "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("starts", none).alias("starts"), F.coalesce("stops", none).alias("stops"),
        F.coalesce("kept_sha256", "_sha").alias("kept_sha256"), F.coalesce("_shared", F.lit(False)).alias("shares_passage"))
