import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import clashing, documents, texts
from wideloom.llm import class_lm
from wideloom.llm.common import fold

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SMALL = {"classes": 4, "frequent": 12, "rounds": 3}


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def held(key):
    return zlib.crc32(str("" if key is None else key).encode()) % 7 == 2


def name(word):
    return int(class_lm.signed(class_lm.hashes(word))[0])


def plain(rows):
    """Tokens, known ones, training tokens and base score per row."""
    count = Counter()
    for key, text in rows:
        if not held(key):
            count.update([*words_of(text), None])
    total, types = sum(count.values()), len(count)
    out = []
    for key, text in rows:
        tokens = [*words_of(text), None]
        out.append((key, held(key), len(tokens), sum(count[t] > 0 for t in tokens), total,
                    round(sum(math.log10((count[t] + 1) / (total + types + 1)) for t in tokens), 6)))
    return out


def scored(spark, rows, **options):
    return class_lm.scored_documents(documents(spark, rows), fold("doc_id", 7) == 2, **(SMALL | options))


def by_text(rows):
    return sorted(rows, key=str)


AWKWARD = list(enumerate(texts(5, 60))) + [(None, "a\x0bb\x1cc d e"), (None, None), (3, "repeated row"), (3, "repeated row")]


def test_base_columns(spark):
    df = scored(spark, AWKWARD)
    assert df.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = [(*r[:5], round(r.base_score, 6)) for r in df.collect()]
    assert by_text(got) == by_text(plain(AWKWARD))


def model_of(spark, rows, **options):
    df = documents(spark, rows).select(F.col("doc_id").alias("key"), (fold("doc_id", 7) != 2).alias("train"),
                                       F.coalesce("text", F.lit("")).alias("text"))
    return class_lm.fit(df, **(SMALL | options))


def test_probabilities_sum_to_one_and_scores_follow_the_model(spark):
    model, encoded = model_of(spark, AWKWARD)
    edge = SMALL["classes"]
    known = {n: (c, k) for n, c, k in zip(model.frequent.view(np.int64).tolist(), model.class_of.tolist(), model.counts.tolist())}
    frequent = set(known)
    known |= {r["name"]: (r["class"], r["n"]) for r in model.rest.collect()}
    assert len(known) + 1 == model.types and sum(k for _, k in known.values()) + model.ends == model.total
    size = np.zeros(edge + 1)
    for c, k in [*known.values(), (edge, model.ends)]:
        size[c] += k
    np.testing.assert_allclose(model.weight @ size + model.unknown, 1.0, atol=1e-9)

    def plain_score(text):
        before, out = [edge, edge], 0.0
        for w in [*words_of(text), None]:
            c, k = (edge, model.ends) if w is None else known.get(name(w), (None, 0))
            out += math.log10(k * model.weight[before[0] * (edge + 1) + before[1], c] if k else model.unknown)
            if w is not None and name(w) in frequent:
                before = [before[1], c]
        return out

    got = {r["row"]: r["score"] for r in class_lm.score(model, encoded, edge).collect()}
    keyed = {r["row"]: r["key"] for r in encoded.collect()}
    by_key = {k: t for k, t in AWKWARD if k not in (None, 3)}  # 3 repeats
    for row, key in keyed.items():
        if key in by_key:
            assert got[row] == pytest.approx(plain_score(by_key[key]), abs=1e-6)


def test_counts_of_a_round_and_single_moves():
    """Sums of a pass against plain counting; a sweep of one word finds the best of all classes."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    for _ in range(20):
        seqs = [rng.integers(0, 6, rng.integers(0, 12)).tolist() for _ in range(8)]
        class_of = rng.integers(0, 3, 6)
        fold_, size = class_lm._neighbours(class_of, 3)
        batch = pa.RecordBatch.from_arrays([pa.array(seqs, pa.list_(pa.int32()))], names=["ids"])
        flat = fold_(batch)
        assert len(flat) == size
        counts = class_lm.Bigrams.of(flat, 6, 3)

        def table(assigned):
            n = np.zeros((4, 4))
            for s in seqs:
                c = [3, *[int(assigned[w]) for w in s], 3]
                for a, b in zip(c, c[1:]):
                    n[a, b] += 1
            return n

        np.testing.assert_array_equal(counts.table(class_of), table(class_of))
        w = int(rng.integers(0, 6))
        moved = class_lm.exchange(counts, class_of, np.array([w]))
        best = max(class_lm.likelihood(table(np.where(np.arange(6) == w, c, class_of))) for c in range(3))
        assert class_lm.likelihood(table(moved)) == pytest.approx(best)


def test_classes_are_learned(spark):
    """Words of two alternating kinds: the classes find the kinds, and the score beats single words."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(("ab", "xy")[j % 2]) + str(rng.randint(0, 400)) for j in range(60))) for i in range(200)]
    df = scored(spark, rows, classes=2, frequent=2000, rounds=10)
    r = df.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.2
    model, _ = model_of(spark, rows, classes=2, frequent=2000, rounds=10)
    assert model.rounds[-1] > model.rounds[0]


def test_a_hot_rare_word_and_small_batches(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "TOKENS", 50)
    rows = [(i, "hot " * 20 + f"w{i % 50} v{i}") for i in range(300)]
    got = [(*r[:5], round(r.base_score, 6)) for r in scored(spark, rows, frequent=1, classes=2).collect()]
    assert by_text(got) == by_text(plain(rows))


def test_nothing_to_learn_from_empty_and_extra(spark):
    assert scored(spark, []).collect() == []
    out = [k for k in range(200) if held(k)][:3]
    for r in scored(spark, [(k, "some text") for k in out]).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
    blank = scored(spark, [(k, None) for k in range(5)]).collect()
    assert all(r.n_tokens == 1 and math.isfinite(r.score) for r in blank)
    df = documents(spark, AWKWARD)
    a, b = (class_lm.scored_documents(x, fold("doc_id", 7) == 2, **SMALL).collect() for x in (df, clashing(df).repartition(5)))
    show = lambda rows: by_text((*r[:5], round(r.base_score, 6), round(r.score, 6)) for r in rows)
    assert show(a) == show(b)
