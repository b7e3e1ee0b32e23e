"""Language-model scores: class-based n-grams over classes found by exchange clustering.

``P(word | history) = (1 - u) [(1 - mix) T(class | two classes before) n(word) / N(class) + mix n(word) / N]``
for a word of the training texts, and ``u`` in all for unknown ones; summed over everything it is 1.

1. Words are counted over all training texts, named by 64-bit hashes.
2. The ``frequent`` words with the most occurrences (a parameter: their table fits in every task)
   make up the history.  Exchange clustering moves each of them to the class that raises the
   likelihood of the class bigrams most.  A round sums, in one pass over the texts, how often every
   frequent word stands next to each class; these sums have a fixed size, whatever the input.  After a
   few rounds only half of the words may move in one, by turns; the best assignment seen is kept.
3. Every other word of the training texts joins, by the same exchange step, the class that gives its
   occurrences between the classes around them the highest likelihood.  Its occurrences are counted per
   pair of neighbouring classes first, so no word has an unbounded group.
4. Class trigrams, smoothed by bigrams and these by the classes' own shares, give the transitions T.
   The rate of words seen once gives u (Good and Turing).
5. Frequent words are scored where their text is read; the others travel to their class and only sums
   per text come back.

Tokens are the runs between white space (code points 9-13 and 32), A-Z lower-cased, and one end per
text, which is a class of its own.  Null and empty texts hold just the end.  Without any training text
every token is unknown and scores 0.  Rows are scored one by one, also those with equal or null keys.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.llm.common import prepared, signed, small, stored, whole_text

CLASSES = 32
FREQUENT = 16_384
ROUNDS = 8
WHOLE = 4  # rounds in which every word may move
MIX = 0.1
PRIOR = 8.0  # weight of the lower order, in occurrences, when transitions are smoothed
TOKENS = 1 << 22  # tokens that a task counts at once
PIECE = 1 << 16  # numbers in a piece of a task's sums


def hashes(text: str) -> np.ndarray:
    """64-bit names of the words of a text, in order."""
    words = text.encode("utf-8").lower().split()  # of bytes: only A-Z, and only white space of ASCII
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _count_words(batches):
    def flush(parts):
        name, n = np.unique(np.concatenate(parts), return_counts=True)
        for i in range(0, len(name), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(signed(name[i:i + (1 << 17)])), pa.array(n[i:i + (1 << 17)].astype(np.int64))],
                                             names=["name", "n"])

    parts, held = [], 0
    for batch in batches:
        for text in batch.column("text").to_pylist():
            parts.append(hashes(text))
            held += len(parts[-1])
            if held >= TOKENS:
                yield from flush(parts)
                parts, held = [], 0
    if parts:
        yield from flush(parts)


def _encode(names: np.ndarray):
    """Per text the places of its frequent words in ``names`` (sorted), and the names of the others with
    the number of frequent words before them."""

    def encode(batches):
        for batch in batches:
            ids, rest, before = [], [], []
            for text in batch.column("text").to_pylist():
                h = hashes(text)
                at = np.searchsorted(names, h)
                known = np.zeros(len(h), bool) if not len(names) else names[np.minimum(at, len(names) - 1)] == h
                ids.append(at[known].astype(np.int32))
                rest.append(signed(h[~known]))
                before.append(np.cumsum(known)[~known].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "key", "train")), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(rest, pa.list_(pa.int64())), pa.array(before, pa.list_(pa.int32()))],
                names=["row", "key", "train", "ids", "rest", "before"])

    return encode


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of a list column without nulls."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat, np.diff(column.offsets.to_numpy())


def _history(column, class_of: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, their classes, index of each text's first, texts' lengths), two edges before each text and
    one behind it.  A word of -1 is an edge."""
    flat, length = _lists(column)
    start = np.concatenate([[0], np.cumsum(length + 3)[:-1]]).astype(np.int64) + 2
    words = np.full(int(length.sum()) + 3 * len(length), -1, np.int64)
    own = np.arange(len(flat)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start, length)
    words[own] = flat
    classes = np.where(words >= 0, class_of[words], edge)
    return words, classes, start, length


def _pieces(total: np.ndarray):
    for i in range(0, len(total), PIECE):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([total[i:i + PIECE].tobytes()], pa.binary())],
                                         names=["at", "body"])


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.frombuffer(pdf["body"].iloc[0], np.int64).copy()
    for body in pdf["body"].iloc[1:]:
        total += np.frombuffer(body, np.int64)
    return pd.DataFrame({"at": [pdf["at"].iloc[0]], "body": [total.tobytes()]})


def _summed(df: DataFrame, fold, size: int) -> np.ndarray:
    """Sum over the tasks of ``df`` of fixed-size integer arrays, added piece by piece."""

    def task(batches):
        total = np.zeros(size, np.int64)
        any_row = False
        for batch in batches:
            if batch.num_rows:
                any_row = True
                total += fold(batch)
        if any_row:
            yield from _pieces(total)

    kind = "at long, body binary"
    out = np.zeros(size, np.int64)
    for r in df.mapInArrow(task, kind).groupBy("at").applyInPandas(_added, kind).collect():
        out[r["at"]:r["at"] + PIECE] = np.frombuffer(r["body"], np.int64)
    return out


def _neighbours(class_of: np.ndarray, classes: int):
    """Counts of (word, class behind it), (class before it, word), words followed by themselves, and
    texts without a frequent word."""
    m, wide = len(class_of), classes + 1

    def fold(batch):
        words, cls, start, length = _history(batch.column("ids"), class_of, classes)
        at = np.flatnonzero(words >= 0)
        w = words[at]
        behind = np.bincount(w * wide + cls[at + 1], minlength=m * wide)
        ahead = np.bincount(w * wide + cls[at - 1], minlength=m * wide)
        same = np.bincount(w[words[at + 1] == w], minlength=m)
        return np.concatenate([behind, ahead, same, [int((length == 0).sum())]])

    return fold, 2 * m * wide + m + 1


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


@dataclass
class Bigrams:
    """What a pass over the texts tells the exchange: counts per word (rows) and class next to it."""

    behind: np.ndarray
    ahead: np.ndarray
    same: np.ndarray
    bare: int

    @classmethod
    def of(cls, flat: np.ndarray, words: int, classes: int) -> Bigrams:
        k = words * (classes + 1)
        return cls(flat[:k].reshape(words, -1).astype(float), flat[k:2 * k].reshape(words, -1).astype(float),
                   flat[2 * k:-1].astype(float), int(flat[-1]))

    def table(self, class_of: np.ndarray) -> np.ndarray:
        """Class bigrams; the last class is the edge of a text."""
        edge = self.behind.shape[1] - 1
        n = np.zeros((edge + 1, edge + 1))
        np.add.at(n, class_of, self.behind)
        np.add.at(n[edge], class_of, self.ahead[:, edge])
        n[edge, edge] = self.bare
        return n


def likelihood(n: np.ndarray) -> float:
    """The part of the class bigrams' log likelihood that depends on the classes."""
    return float(_xlogx(n).sum() - _xlogx(n.sum(0)).sum() - _xlogx(n.sum(1)).sum())


def exchange(counts: Bigrams, class_of: np.ndarray, movable: np.ndarray) -> np.ndarray:
    """One sweep: each movable word, in the given order, goes to the class of the highest likelihood."""
    out, n = class_of.copy(), counts.table(class_of)
    classes = n.shape[0] - 1
    b = np.arange(classes)
    for w in movable:
        a, s = out[w], counts.same[w]
        r, c = counts.behind[w].copy(), counts.ahead[w].copy()
        r[class_of[w]] -= s  # the word next to itself moves along with it
        c[class_of[w]] -= s
        n[a] -= r
        n[:, a] -= c
        n[a, a] -= s
        base = np.maximum(n, 0)
        gain = (_xlogx(base[:classes] + r) - _xlogx(base[:classes])).sum(1)
        gain += (_xlogx(base[:, :classes] + c[:, None]) - _xlogx(base[:, :classes])).sum(0)
        own = base[b, b]
        gain += _xlogx(own + r[b] + c[b] + s) - _xlogx(own + r[b]) - _xlogx(own + c[b]) + _xlogx(own)
        rows, cols = base.sum(1)[:classes] + c[:classes], base.sum(0)[:classes] + r[:classes]
        gain -= _xlogx(rows + r.sum() + s) - _xlogx(rows) + _xlogx(cols + c.sum() + s) - _xlogx(cols)
        best = int(np.argmax(gain))
        if gain[best] <= gain[a] + 1e-9:
            best = a
        n[best] += r
        n[:, best] += c
        n[best, best] += s
        out[w] = best
    return out


def word_classes(encoded: DataFrame, frequent: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS
                 ) -> tuple[np.ndarray, list[float]]:
    """(class of each frequent word, likelihood after each round).

    ``encoded`` holds the ``ids`` of the training texts and ``frequent`` the words' counts.  The words
    start in classes dealt out by rank.
    """
    order = np.argsort(-frequent, kind="stable")
    class_of = np.zeros(len(frequent), np.int64)
    class_of[order] = np.arange(len(frequent)) % classes
    best, seen = class_of, []
    for i in range(rounds + 1):
        fold, size = _neighbours(class_of, classes)
        counts = Bigrams.of(_summed(encoded.select("ids"), fold, size), len(frequent), classes)
        seen.append(likelihood(counts.table(class_of)))
        if seen[-1] >= max(seen):
            best = class_of
        if i < rounds:
            turn = order[(order % 2 == i % 2) | (i < WHOLE)]
            class_of = exchange(counts, class_of, turn)
    return best, seen


def _rest_contexts(class_of: np.ndarray, classes: int, train: bool):
    """One row per other word of a text: its name and the classes around it, as one number, counted in
    the task if they are for training."""
    wide = classes + 1

    def contexts(batch):
        _, cls, start, _ = _history(batch.column("ids"), class_of, classes)
        name, length = _lists(batch.column("rest"))
        at = np.repeat(start, length) + batch.column("before").flatten().to_numpy(zero_copy_only=False)
        before = cls[at - 2] * wide + cls[at - 1]
        return name, length, before, before * wide + cls[at]

    def counted(batches):
        parts, held = [], 0

        def flush():
            name = np.concatenate([p[0] for p in parts])
            code = np.concatenate([p[1] for p in parts])
            order = np.lexsort((code, name))
            name, code = name[order], code[order]
            first = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | (code[1:] != code[:-1])]))
            n = np.diff(np.append(first, len(name)))
            for i in range(0, len(first), 1 << 17):
                f = first[i:i + (1 << 17)]
                yield pa.RecordBatch.from_arrays([pa.array(name[f]), pa.array(code[f].astype(np.int32)), pa.array(n[i:i + (1 << 17)])],
                                                 names=["name", "code", "n"])

        for batch in batches:
            name, _, _, code = contexts(batch)
            if len(name):
                parts.append((name, code))
                held += len(name)
                if held >= TOKENS // 2:
                    yield from flush()
                    parts, held = [], 0
        if parts:
            yield from flush()

    def placed(batches):
        for batch in batches:
            name, length, before, _ = contexts(batch)
            if len(name):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("row").to_numpy(), length)), pa.array(name), pa.array(before.astype(np.int32))],
                    names=["row", "name", "before"])

    return counted if train else placed


_REST = pa.schema([("name", pa.int64()), ("class", pa.int32()), ("n", pa.int64()), ("before", pa.int32())])


def _assign(gain: np.ndarray, classes: int):
    """Rows (name, code, n), equal names together: a row per word with its class and occurrences, then
    the task's class trigrams (without a name)."""
    wide = classes + 1

    def settle(name, code, n, trigrams):
        first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
        best = np.empty(len(first), np.int64)
        step = 1 << 15
        for i in range(0, len(first), step):
            lo, hi = first[i], first[i + step] if i + step < len(first) else len(name)
            around = code[lo:hi] % (wide * wide)
            best[i:i + step] = np.add.reduceat(gain[around] * n[lo:hi, None], first[i:i + step] - lo).argmax(1)
        every = np.repeat(best, np.diff(np.append(first, len(name))))
        np.add.at(trigrams, (code // wide, every), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(name[first]), pa.array(best.astype(np.int32)), pa.array(np.add.reduceat(n, first)),
             pa.array(np.full(len(first), -1, np.int32))], schema=_REST)

    def assign(batches):
        trigrams = np.zeros((wide * wide, classes), np.int64)
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(c).to_numpy() for c in ("name", "code", "n")])
                rows += batch.num_rows
            if rows < 1 << 17:
                continue
            name, code, n = (np.concatenate(x) for x in zip(*held))
            cut = int(np.searchsorted(name, name[-1]))  # the last word may go on in the next batch
            if cut:
                yield from settle(name[:cut], code[:cut], n[:cut], trigrams)
            held, rows = [[name[cut:], code[cut:], n[cut:]]], len(name) - cut
        if held:
            yield from settle(*(np.concatenate(x) for x in zip(*held)), trigrams)
        before, cls = np.nonzero(trigrams)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(before), pa.int64()), pa.array(cls.astype(np.int32)), pa.array(trigrams[before, cls]),
             pa.array(before.astype(np.int32))], schema=_REST)

    return assign


def smoothed(trigrams: np.ndarray, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """(T of [two classes before, class], T of [class before, class]) from counts by (one, two, class)."""
    with np.errstate(invalid="ignore", divide="ignore"):
        own = trigrams.sum((0, 1))
        own = own / max(own.sum(), 1)
        pairs = trigrams.sum(0)
        two = (pairs + prior * own) / (pairs.sum(1, keepdims=True) + prior)
        three = (trigrams + prior * two) / (trigrams.sum(2, keepdims=True) + prior)
    return three, two


def _score_frequent(class_of: np.ndarray, classes: int, n: np.ndarray, ends: int, total: int, types: int, weight: np.ndarray,
                    unknown: float):
    """Per text: tokens, and for its frequent words and the end how many are known and their scores."""
    known_end = ends > 0
    out_of = np.log10(max(total + types + 1, 1))
    base = np.log10(n + 1) - out_of
    end_base = np.log10(ends + 1) - out_of
    wide = classes + 1

    def score(batches):
        for batch in batches:
            words, cls, start, length = _history(batch.column("ids"), class_of, classes)
            rest = np.diff(batch.column("rest").offsets.to_numpy())
            at = np.flatnonzero(words >= 0)
            before = cls[at - 2] * wide + cls[at - 1]
            logs = np.log10(n[words[at]] * weight[before, cls[at]])
            owner = np.repeat(np.arange(len(length)), length)
            last = start + length
            end = np.log10(ends * weight[cls[last - 2] * wide + cls[last - 1], classes]) if known_end else np.full(len(length), np.log10(unknown))
            size = len(length)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array((length + rest + 1).astype(np.int64)), pa.array((length + known_end).astype(np.int64)),
                 pa.array(np.bincount(owner, base[words[at]], size) + end_base), pa.array(np.bincount(owner, logs, size) + end)],
                names=["row", "n_tokens", "n_known", "base_score", "score"])

    return score


@dataclass
class Model:
    """Fitted classes and counts.  ``weight`` turns a token's count into its probability, by the two
    classes before it and its own."""

    frequent: np.ndarray  # names, sorted
    counts: np.ndarray
    class_of: np.ndarray
    rest: DataFrame  # name, class, n of the other words
    weight: np.ndarray
    unknown: float
    total: int
    types: int
    ends: int
    rounds: list[float]


def _trigrams(class_of: np.ndarray, classes: int):
    wide = classes + 1

    def fold(batch):
        words, cls, start, length = _history(batch.column("ids"), class_of, classes)
        at = np.concatenate([np.flatnonzero(words >= 0), start + length])
        return np.bincount((cls[at - 2] * wide + cls[at - 1]) * wide + cls[at], minlength=wide ** 3)

    return fold, wide ** 3


def encode(rows: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(row, key, train, ids, rest, before) of (key, train, text); ``row`` is unique."""
    key = rows.schema["key"].dataType.simpleString()
    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "train", "text")
    return stored(numbered.mapInArrow(
        _encode(frequent), f"row long, key {key}, train boolean, ids array<int>, rest array<bigint>, before array<int>"), "lm-encoded")


def fit(rows: DataFrame, classes: int = CLASSES, frequent: int = FREQUENT, rounds: int = ROUNDS, mix: float = MIX,
        prior: float = PRIOR) -> tuple[Model, DataFrame]:
    """(model, encoded rows) of (key, train, text); learns from the rows marked ``train``."""
    train = rows.where("train")
    words = stored(train.select("text").mapInArrow(_count_words, "name long, n long").groupBy("name").agg(F.sum("n").alias("n")), "lm-words")
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("types"), F.count_if(F.col("n") == 1).alias("once")).first()
    ends = train.count()
    top = words.orderBy(F.desc("n"), "name").limit(frequent).toPandas()  # at most ``frequent`` rows
    names = top["name"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(names)
    names, n = names[order], top["n"].to_numpy(np.int64)[order]
    total, types = sums["total"] + ends, sums["types"] + (ends > 0)
    unknown = (sums["once"] + 1) / (total + types + 1)

    encoded = encode(rows, names)
    texts = encoded.where("train")
    class_of, seen = word_classes(texts, n, classes, rounds) if len(n) else (np.zeros(1, np.int64), [])
    wide = classes + 1
    fold, size = _trigrams(class_of, classes)
    trigrams = _summed(texts.select("ids"), fold, size).reshape(wide, wide, wide)
    _, two = smoothed(trigrams.astype(float), prior)
    with np.errstate(divide="ignore"):
        log_two = np.log(np.maximum(two, 1e-12))
    # For a word between two classes: the likelihood of coming behind the first and before the second,
    # without what a large class gains by size alone.
    share = np.log(np.maximum(trigrams.sum((0, 1)), 1.0))
    gain = (log_two[:, None, :classes] + log_two[:classes, :].T[None, :, :] - share[:classes]).reshape(wide * wide, classes)
    counted = texts.select("ids", "rest", "before").mapInArrow(_rest_contexts(class_of, classes, True), "name long, code int, n long")
    dealt = counted.repartition("name").groupBy("name", "code").agg(F.sum("n").alias("n")).sortWithinPartitions("name")
    rest = stored(dealt.mapInArrow(_assign(gain, classes), "name long, class int, n long, before int"), "lm-classes")
    for r in rest.where("name is null").groupBy("before", "class").agg(F.sum("n").alias("n")).collect():  # fixed by ``classes``
        trigrams[r["before"] // wide, r["before"] % wide, r["class"]] += r["n"]
    three, _ = smoothed(trigrams.astype(float), prior)
    own = np.maximum(trigrams.sum((0, 1)), 1)
    weight = (1 - unknown) * ((1 - mix) * three / own + mix / max(total, 1))
    model = Model(names, n, class_of, rest.where("name is not null").select("name", "class", "n"), weight.reshape(wide * wide, wide),
                  unknown, total, types, ends, seen)
    return model, encoded


def score(model: Model, encoded: DataFrame, classes: int = CLASSES) -> DataFrame:
    """(row, n_tokens, n_known, base_score, score) of every encoded row."""
    scored = encoded.select("row", "ids", "rest").mapInArrow(
        _score_frequent(model.class_of, classes, model.counts, model.ends, model.total, model.types, model.weight, model.unknown),
        "row long, n_tokens long, n_known long, base_score double, score double")
    placed = encoded.select("row", "ids", "rest", "before").mapInArrow(
        _rest_contexts(model.class_of, classes, False), "row long, name long, before int")
    wide = classes + 1
    weights = encoded.sparkSession.createDataFrame(pd.DataFrame({
        "cell": np.arange(wide * wide * wide), "weight": model.weight.ravel()}), "cell long, weight double")  # fixed by ``classes``
    out_of = float(np.log10(max(model.total + model.types + 1, 1)))
    cell: Column = F.col("before").cast("long") * wide + F.coalesce("class", F.lit(0))
    rest = (placed.join(small(model.rest), "name", "left").withColumn("cell", cell).join(F.broadcast(weights), "cell").groupBy("row").agg(
        F.count("n").alias("_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1) - out_of).alias("_base"),
        F.sum(F.log10(F.coalesce(F.col("n") * F.col("weight"), F.lit(float(model.unknown))))).alias("_score")))
    plus = lambda c, d: (F.col(c) + F.coalesce(d, F.lit(0))).alias(c)
    return scored.join(rest, "row", "left").select("row", "n_tokens", plus("n_known", "_known"), plus("base_score", "_base"), plus("score", "_score"))


def scored_documents(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    The model learns from the rows that are not ``held_out`` (null counts as held out).  ``base_score``
    is that of single words, one added to each count; both scores are sums of log10 probabilities.
    """
    prepared(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), (~F.coalesce(held_out, F.lit(True))).alias("train"), whole_text(text).alias("text"))
    model, encoded = fit(rows, **options)
    done = score(model, encoded, options.get("classes", CLASSES))
    return encoded.select("row", "key", "train").join(done, "row").select(
        F.col("key").alias(key), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"),
        "base_score", "score")
