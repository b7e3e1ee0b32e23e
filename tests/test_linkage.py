"""Average and complete linkage beyond what the driver merges, against the tree of all distances."""

import numpy as np
import pyarrow as pa
import pytest

from wideloom.operators import hierarchy as H
from wideloom.operators import linkage as L
from wideloom.operators import meanshift as MS
from wideloom.operators import neighbors as N
from wideloom.plans import sweeps as SW


def frame(spark, x):
    return spark.createDataFrame(pa.table({"k": pa.array(np.arange(len(x))), "v": pa.array(list(x))})).repartition(4)


def labels(df):
    return np.array([r.cluster for r in df.orderBy("k").collect()])


@pytest.mark.parametrize("linkage", ["average", "complete"])
def test_rounds_equal_the_dense_tree(spark, linkage):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(120, 3)) * 0.02, rng.normal(size=(60, 3)) * 2 + 3])  # one group exceeds a block
    x[130:140] = x[7]  # copies weigh in
    want = H.merge_tree(N.pair_distances(x, x), np.ones(len(x)), 6, linkage)
    got = labels(L.pair_linkage(frame(spark, x), "k", "v", 6, linkage, 25, block=8))
    assert np.array_equal(got, want)


def test_query_operator_keeps_rows_apart_beyond_512(spark):
    """More distinct rows than the micro-clusters that used to stand for them."""
    x = np.random.default_rng(9).normal(size=(900, 3))
    for linkage in ("average", "complete"):
        got = labels(H.agglomerative(frame(spark, x), "k", "v", 300, linkage))
        assert np.array_equal(got, H.merge_tree(N.pair_distances(x, x), np.ones(len(x)), 300, linkage))


def test_many_label_tuples_make_one_consensus(spark, monkeypatch):
    """More tuples than a matrix of distances is held for: the same groups, and no error."""
    rng = np.random.default_rng(4)
    g = rng.integers(0, 4, 90)
    t = np.stack([g, np.where(rng.random(90) < 0.1, -1, g), rng.integers(0, 20, 90)], axis=1)
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(t)], "k bigint, a int, b int, c int")
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    _, first = np.unique(g, return_index=True)
    want = np.argsort(np.argsort(first))[g]
    assert np.array_equal(labels(H.ensemble(df, "k", list("abc"), weights, 4)), want)
    monkeypatch.setattr(H, "MAX_SIGNATURES", 8)
    assert np.array_equal(labels(H.ensemble(df, "k", list("abc"), weights, 4)), want)


def test_mean_shift_starts_from_every_row(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 2)) * 0.3 + rng.integers(0, 3, 700)[:, None] * 3
    x[600] = x[1]
    monkeypatch.setattr(MS, "LOT", 900)  # two lots
    got, modes = MS.mean_shift(frame(spark, x), "k", "v", 0.8, max_seeds=None)
    _, first = np.unique(x, axis=0, return_index=True)
    end = x[np.sort(first)]
    for _ in range(300):
        w = np.exp(-0.5 * (N.pair_distances(end, x) / 0.8) ** 2)
        new = w @ x / w.sum(1, keepdims=True)
        moved = np.linalg.norm(new - end, axis=1)
        end = new
        if (moved < 1e-3).all():
            break
    want_modes, want = MS.merge_modes(end, 0.4)
    got = labels(got)
    assert np.array_equal(got[np.sort(first)], want) and got[600] == got[1] and len(modes) == len(want_modes)


def test_sweep_lets_no_row_stand_for_others(spark, monkeypatch):
    def few(*_, **__):
        raise AssertionError("micro-clusters stand for the rows")

    for module in (H, MS):
        monkeypatch.setattr(module, "micro_clusters", few)
    x = np.random.default_rng(1).normal(size=(60, 3))
    df = frame(spark, x).selectExpr("k", "v", "int(k % 2) AS label")
    names = ["agglomerative_ward", "agglomerative_average", "mean_shift"]
    out, _ = SW.many_algorithms(df, "k", "v", "label", 4, which=names, max_iter=20, max_micro=8)
    got = np.array([r.agglomerative_average for r in out.orderBy("k").collect()])
    assert np.array_equal(got, H.merge_tree(N.pair_distances(x, x), np.ones(60), 4, "average"))
