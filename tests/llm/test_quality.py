import random

import numpy as np

from cases import clashing, documents, prose, texts
from wideloom.llm import quality
from wideloom.llm.common import stored
from wideloom.llm.queries import QUERIES


def corpus(seed, n):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        y = int(rng.random() < 0.8)
        t = prose(rng, rng.randint(20, 120))
        if not y:
            t = rng.choice([t.upper().replace(" ", "!! "), " ".join([w] * 8 for w in []) or " ".join(
                w for w in t.split()[:12] for _ in range(9)), t.replace(" ", " | ")])
        rows.append((i, t))
        labels.append((i, y, 0))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def stats_of(df):
    return stored(df.select("doc_id", quality.statistics_of().alias("stats")))


def test_held_out_accuracy(spark, tmp_path):
    rows, labels = corpus(1, 1000)
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    label_frame(spark, labels).write.parquet(str(tmp_path / "labels.parquet"))
    out = QUERIES["op1_quality"](spark, str(tmp_path)).toPandas()
    truth = {k: y for k, y, _ in labels}
    out = out[out.held_out]
    assert np.mean([truth[k] == p for k, p in zip(out.doc_id, out.predicted)]) > 0.97
    assert out.score.between(0, 1).all() and ((out.score >= 0.3).astype(int) == out.predicted).all()


def test_summed_equations_are_the_ridge_solution(spark):
    rows, labels = corpus(2, 200)
    stats = stats_of(documents(spark, rows))
    model = quality.fit(stats, label_frame(spark, labels), size=32)
    truth = {k: y for k, y, _ in labels}
    got = stats.collect()
    x, y = np.array([r.stats for r in got]), np.array([truth[r.doc_id] for r in got], float)
    assert np.allclose(model.features.mean, x.mean(axis=0))
    phi = model.features.of(x)
    penalty = np.eye(33)
    penalty[0, 0] = 1e-6
    assert np.allclose(model.weight, np.linalg.solve(phi.T @ phi + penalty, phi.T @ y), atol=1e-6)


def test_kernel_is_approximated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 5))
    f = quality.Features.draw(np.zeros(5), np.ones(5), 20000, 1.0, 3)
    phi = f.of(x)[:, 1:]
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert np.abs(phi @ phi.T - np.exp(-d2 / 10)).max() < 0.05


def test_isotonic_against_least_squares():
    rng = np.random.default_rng(2)
    for _ in range(30):
        y, w = rng.random(12), rng.integers(1, 9, 12).astype(float)
        x = np.arange(12.0)
        _, values = quality.isotonic(x, y, w)
        # The fit at i is the max over starts of the min over ends of the weighted means.
        want = [max(min(np.average(y[a:b + 1], weights=w[a:b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(sorted(set(np.round(values, 9))), sorted(set(np.round(want, 9))))


def test_awkward_rows(spark):
    rows, labels = corpus(3, 80)
    rows += [(100 + i, t) for i, t in enumerate(texts(3, 3))] + [(None, "x")]
    labels += [(0, 1 - labels[0][1], 0), (None, 1, 0), (101, None, 0)]
    df = clashing(documents(spark, rows))
    stats = stats_of(df)
    model = quality.fit(stats, label_frame(spark, labels))
    got = stats.select(model.score("stats").alias("p")).collect()
    assert len(got) == len(rows) and all(0 <= r.p <= 1 for r in got)
    assert quality.statistics("") == quality.statistics(None) == [0.0] * len(quality.STATISTICS)
    assert all(np.isfinite(quality.statistics(t)).all() for t in ["\n", " ", "a", "é" * 9, "😀"])


def test_without_labels_or_rows(spark):
    stats = stats_of(documents(spark, texts(4, 3)))
    none = quality.fit(stats, label_frame(spark, []))
    assert {r.p for r in stats.select(none.score("stats").alias("p")).collect()} == {0.5}
    assert stats_of(documents(spark, [])).select(none.score("stats").alias("p")).collect() == []
