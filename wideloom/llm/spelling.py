"""Spelling variants: words one edit apart, found by pivotal grams, and the form they stand for.

One edit (a code point inserted, deleted or replaced) destroys at most one of two disjoint bigrams:

1. Bigrams are ranked over the vocabulary, rare ones first.  A word's prefix is its three rarest
   bigrams (with every bigram of the rank of the third), and its pivots are the two disjoint ones of
   the prefix with the least total frequency, chosen by dynamic programming.
2. Let s be the word of a pair whose prefix ends no later in the ranking.  A pivot of s that the edit
   leaves whole is among the bigrams of the other word r, and as it is ranked no later than the last
   one of r's prefix, it is in that prefix.
3. Position limits: if the edit lies behind the left pivot, that gram has the same distance from the
   start in both words and what leads up to it is equal; if not, the edit lies before the right
   pivot, which has the same distance from the end, and what follows it is equal.
4. The letters on the other side of the pivot are cut in halves, one of which the edit leaves whole.
   A key is the position, the equal letters at the pivot and such a half: every word asks with four
   keys, and has eight for each bigram of its prefix, as the other word may be a letter longer or shorter.
5. Words that meet under a key, with half of their letters equal, are verified by their edit distance.

There are at most ``LETTERS`` squared bigrams, whatever the vocabulary, so the ranking fits in every
task.  Words are counted in the tasks before anything is shuffled, so a frequent one is no hot key.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import prepared, signed, stored, whole_text

LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
FLUSH = 200_000  # distinct words that a task counts before it sends them on

_RUN = re.compile("[a-zÀ-ÿ]+")


def _counted(every: int, least: int):
    """Words of (key, text) rows with their counts; one run in ``every`` loses a code point."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                start = zlib.crc32(f"{key}:".encode())
                for run, n in Counter(_RUN.findall(text.encode("utf-8").lower().decode("utf-8"))).items():
                    if len(run) < least:
                        continue
                    h = zlib.crc32(run.encode("utf-8"), start)
                    if every and h % every == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least:
                            continue
                    seen[run] += n
                if len(seen) >= FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                                     names=["word", "n"])
                    seen = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                         names=["word", "n"])

    return count


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = 7, least: int = 2,
                  every: int = 31) -> DataFrame:
    """(word, n): the distinct letter runs of all texts, A-Z lower-cased, with their occurrences.

    A run whose crc32 (with its document's key in front) is divisible by ``every`` has one code point
    deleted; 0 leaves all runs alone.  Null texts have no words, a null key is written as empty.
    """
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), whole_text(text).alias("text"))
    return (rows.mapInArrow(_counted(every, least_letters), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def disjoint_pair(grams: list[tuple[int, int]], width: int = 2) -> tuple[int, int]:
    """Positions of two grams that do not overlap, with the least total weight.

    ``grams`` are (position, weight) by position.  One step per gram: the best single gram among
    those that end before it is known, so is the best pair so far.
    """
    best: tuple = (float("inf"),)
    single: tuple = (float("inf"),)
    behind = 0
    for at, weight in grams:
        while grams[behind][0] + width <= at:
            single = min(single, (grams[behind][1], grams[behind][0]))
            behind += 1
        if single[0] + weight < best[0]:
            best = (single[0] + weight, single[1], at)
    return best[1], best[2]


def _behind(word: str, end: int, near: int, far: int) -> tuple[str, str]:
    """Keys of a word whose first ``end`` letters are equal, and then the next ``near`` or its last ``far``."""
    return f"<{end} {word[:end + near]}", f"({end} {word[:end]} {word[len(word) - far:]}"


def _before(word: str, start: int, near: int, far: int) -> tuple[str, str]:
    """The same for the letters from ``start`` on, and the ``near`` before them or the first ``far``."""
    return f">{len(word) - start} {word[start - near:]}", f"){len(word) - start} {word[start:]} {word[:far]}"


def _index_keys(word: str, at: int) -> set[str]:
    out = set()
    for side, place, beside in ((_behind, at + 2, len(word) - at - 2), (_before, at, at)):
        for d in (-1, 0, 1):
            other = max(0, beside + d)  # letters on that side of the word that asks
            near, far = other // 2, other - other // 2
            keys = side(word, place, min(near, beside), min(far, beside))
            out.update(k for k, size in zip(keys, (near, far)) if size <= beside)
    return out


def _signatures(rank: dict[str, int], weight: dict[str, int]):
    """A row per key of a word: ``pivot`` keys ask, the others are the index."""

    def sign(batches):
        for batch in batches:
            words, counts, lasts, pivots, keys = [], [], [], [], []
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                grams = [word[i:i + 2] for i in range(len(word) - 1)]
                ranks = [rank[g] for g in grams]
                last = sorted(ranks)[:3][-1]
                prefix = [i for i, r in enumerate(ranks) if r <= last]
                left, right = disjoint_pair([(i, weight[grams[i]]) for i in prefix])
                behind = len(word) - left - 2
                own = [*_behind(word, left + 2, behind // 2, behind - behind // 2), *_before(word, right, right // 2, right - right // 2)]
                asked = len(own)
                own += set().union(*(_index_keys(word, i) for i in prefix))
                words += [word] * len(own)
                counts += [n] * len(own)
                lasts += [last] * len(own)
                pivots += [True] * asked + [False] * (len(own) - asked)
                keys += own
            names = np.fromiter((xxhash.xxh3_64_intdigest(k.encode("utf-8")) for k in keys), np.uint64, len(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(counts, pa.int64()), pa.array(lasts, pa.int32()),
                 pa.array(pivots, pa.bool_()), pa.array(signed(names))], names=["word", "n", "last", "pivot", "key"])

    return sign


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every two words one edit apart, in both directions.

    ``words`` are (word, n), distinct, of at least four code points from at most a few thousand
    different bigrams.
    """
    grams = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))
    ranked = words.select(grams.alias("gram")).groupBy("gram").agg(F.count("*").alias("n")).collect()  # LETTERS ** 2 at most
    weight = {r["gram"]: r["n"] for r in ranked}
    rank = {g: i for i, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
    keys = stored(words.mapInArrow(_signatures(rank, weight), "word string, n long, last int, pivot boolean, key long"),
                  "spelling-keys")
    asks = keys.where("pivot").select("key", "word", "n", F.col("last").alias("one"))
    index = keys.where("not pivot").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("last").alias("two"))
    length: Column = F.abs(F.length("word") - F.length("near"))
    found = asks.join(index, "key").where((F.col("one") <= F.col("two")) & (length <= 1) & (F.col("word") != F.col("near"))
                                          & (F.levenshtein("word", "near", 1) == 1))
    pairs = found.select("word", "n", "near", "near_n")
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                          F.col("word").alias("near"), F.col("n").alias("near_n"))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, by doubling; a form has ``ratio`` times the occurrences."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.join(at.select(F.col("word").alias("root"), F.col("root").alias("next")), "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = stored(step, "spelling-roots")
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at


def variant_groups(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n).

    A word's form is its near word of the largest n (ties: the smallest in code-point order) if that
    is at least ``ratio`` times its own (over 1, so that forms end); else null.
    """
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    prepared(words.sparkSession)
    words = stored(words, "spelling-words")
    near = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    told = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= ratio * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")))
        .alias("form")), "spelling-near").select("word", "n", "n_near", "form.form", "form.form_n")
    return told.join(_roots(told.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least_letters: int = 7, least: int = 2,
                      every: int = 31, ratio: int = 10) -> DataFrame:
    """``variant_groups`` of the words of all texts; words need at least four code points."""
    if least_letters < 4:
        raise ValueError("words need at least 4 code points")
    prepared(docs.sparkSession)
    return variant_groups(counted_words(docs, key, text, least_letters, least, every), ratio)
