import random

import numpy as np

from cases import WORDS, clashing, documents, prose, texts
from wideloom.llm import toxicity
from wideloom.llm.common import fold
from wideloom.llm.queries import QUERIES

BAD = ["vile scum", "utter fool", "worthless", "pathetic"]


def corpus(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        t, y = prose(rng, rng.randint(20, 150)), int(rng.random() < 0.2)
        if y:
            w = t.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
            t = " ".join(w)
        rows.append((i, t))
        labels.append((i, 1, y))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, tmp_path):
    rows, labels = corpus(1, 1500)
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    label_frame(spark, labels).write.parquet(str(tmp_path / "labels.parquet"))
    out = QUERIES["op8_toxicity"](spark, str(tmp_path)).toPandas()
    truth = {k: y for k, _, y in labels}
    out = out[out.held_out]
    assert 200 < len(out) < 400
    assert np.mean([truth[k] == p for k, p in zip(out.doc_id, out.predicted)]) > 0.97
    assert out.score.between(0, 1).all() and ((out.score >= 0.5).astype(int) == out.predicted).all()


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows, labels = corpus(2, 300)
    held = {r.doc_id for r in label_frame(spark, labels).where(fold("doc_id") == 0).collect()}
    turned = [(k, q, 1 - y if k in held else y) for k, q, y in labels]
    docs = documents(spark, rows)
    a, b = (toxicity.fit(docs, label_frame(spark, x).where(fold("doc_id") != 0)) for x in (labels, turned))
    assert np.array_equal(a.index, b.index) and np.allclose(a.weight, b.weight) and a.bias == b.bias


def test_weights_are_sparse_and_point_at_the_bad_words(spark):
    rows, labels = corpus(3, 1200)
    model = toxicity.fit(documents(spark, rows), label_frame(spark, labels))
    assert 0 < len(model.index) < 5000
    score = lambda t: float(sum(model.weight[np.isin(model.index, toxicity.features(t, model.bits))]))
    assert score("you worthless thing") > score(" ".join(WORDS))


def test_sample_bound(spark):
    rows, labels = corpus(4, 600)
    model = toxicity.fit(documents(spark, rows), label_frame(spark, labels), settings=toxicity.Settings(max_rows=100))
    assert 50 < model.rows < 160


def test_awkward_rows(spark):
    rows, labels = corpus(5, 60)
    rows += [(100 + i, t) for i, t in enumerate(texts(5, 3))] + [(None, "x")]
    labels += [(0, 1, 1 - labels[0][2]), (100, 1, None), (None, 1, 1), (7777, 1, 1)]
    docs = clashing(documents(spark, rows))
    model = toxicity.fit(docs, label_frame(spark, labels))
    got = docs.select("doc_id", model.score().alias("p")).collect()
    assert len(got) == len(rows) and all(0 <= r.p <= 1 for r in got)
    blank = docs.where("text is null or text = ''").select(model.score().alias("p")).distinct().collect()
    assert len(blank) == 1


def test_without_labels_or_rows(spark):
    docs = documents(spark, texts(6, 3))
    none = toxicity.fit(docs, label_frame(spark, []))
    assert {r.p for r in docs.select(none.score().alias("p")).collect()} == {0.5}
    assert documents(spark, []).select(none.score().alias("p")).collect() == []


def plain_ftrl(rows, s):
    """FTRL-proximal by the book, one coordinate after another in dictionaries."""
    z, n = {}, {}

    def weight(i):
        if i == "bias":
            return -z.get(i, 0.0) / ((s.beta + n.get(i, 0.0) ** 0.5) / s.alpha)
        if abs(z.get(i, 0.0)) <= s.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)

    for idx, y in rows:
        w = {i: weight(i) for i in [*idx.tolist(), "bias"]}
        g = 1 / (1 + np.exp(-sum(w.values()))) - y
        for i, v in w.items():
            rate = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / s.alpha
            z[i] = z.get(i, 0.0) + g - rate * v
            n[i] = n.get(i, 0.0) + g * g
    return z, n, weight


def test_a_pass_against_plain_ftrl(spark):
    rows, labels = corpus(6, 120)
    s = toxicity.Settings(bits=14, shards=1, rounds=1)
    data = [(toxicity.features(t, s.bits), y) for (_, t), (_, _, y) in zip(rows, labels)]
    z, n = np.zeros((1 << s.bits) + 1), np.zeros((1 << s.bits) + 1)
    toxicity._epoch(data, z, n, s)
    want_z, want_n, weight = plain_ftrl(data, s)
    for i, v in want_z.items():
        at = len(z) - 1 if i == "bias" else i
        assert abs(z[at] - v) < 1e-9 and abs(n[at] - want_n[i]) < 1e-9
    # A fit of one shard and one round is that pass over its rows, in the order of their hashes.
    docs = documents(spark, rows)
    order = [r.doc_id for r in docs.selectExpr("doc_id", "xxhash64(doc_id, 17) as o").orderBy("o").collect()]
    _, _, weight = plain_ftrl([data[i] for i in order], s)
    model = toxicity.fit(docs, label_frame(spark, labels), settings=s)
    assert abs(model.bias - weight("bias")) < 1e-4 and len(model.index)
    np.testing.assert_allclose(model.weight, [weight(int(i)) for i in model.index], atol=1e-4)
