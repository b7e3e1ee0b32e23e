"""Fits that share their passes give what each gives alone."""

import numpy as np
import pyarrow as pa
import pytest

from wideloom.operators import evaluate as E
from wideloom.operators import gmm as G
from wideloom.operators import kmeans as K
from wideloom.operators import reduce as R
from wideloom.operators import rowsums as S
from wideloom.plans import sweeps as SW


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(11)
    y = np.arange(90) % 3
    x = rng.laplace(size=(90, 5)) + 6 * np.eye(5)[y]
    return spark.createDataFrame(pa.table({"k": pa.array(np.arange(90)), "label": pa.array(y), "v": pa.array(list(x))})).repartition(3).persist()


def counted(monkeypatch, module, name):
    calls, fn = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: (calls.append(a), fn(*a, **k))[1])
    return calls


@pytest.mark.parametrize("direct_bytes", [S.DIRECT_BYTES, 0])
@pytest.mark.parametrize("direct", [S.DIRECT, 1])
def test_kept_rows_sum_as_the_frame_does(small, monkeypatch, direct, direct_bytes):
    monkeypatch.setattr(S, "DIRECT", direct)
    monkeypatch.setattr(S, "DIRECT_BYTES", direct_bytes)
    rows = S.KeptRows(small, ["k", "v"])
    part = lambda k, x: (np.array([k.sum()]), x.T @ x, np.zeros((2, 0)))
    least = lambda k, x: (np.array([x[:, 0].min()]), x[[x[:, 0].argmin()]])
    for fn, merge in ((part, S.add), (least, S.keep_smallest)):
        for a, b in zip(S.sum_rows(rows, ["k", "v"], fn, merge, 30), S.sum_rows(small, ["k", "v"], fn, merge, 30)):
            assert a.shape == b.shape and np.allclose(a, b)
    assert rows.width("v") == 5
    rows.unpersist()


def test_kept_rows_refuse_what_a_fit_refuses(spark):
    holes = spark.createDataFrame([(1, [1.0, None]), (2, [2.0, 3.0])], "k int, v array<double>")
    with pytest.raises(Exception, match="null or NaN"):
        K.fit_many(holes, "k", "v", {"m": K.Spec(1, 1)})


def test_sources_of_several_counts(small):
    many = R.ica_many(small, "v", [2, 4], 50, 1e-3)
    for c in (2, 4):
        alone = R.ica(small, "v", c, 50, 1e-3)
        assert np.allclose(many[c].matrix, alone.matrix) and many[c].rounds == alone.rounds


def test_grid_is_one_fit_and_as_before(small, monkeypatch):
    fits = counted(monkeypatch, SW, "fit_many")
    got = {(r.method, r.n_components): r.silhouette for r in SW.reduction_grid(
        small, "k", "v", 3, ("pca", "ica", "truncated_svd"), (2, 3), 2).collect()}
    assert len(fits) == 1 and len(got) == 6
    for method, c in got:
        z = R.reduce_by(small, "k", "v", method, c if method == "ica" else 3).transform(small, "v", "z")
        model = K.fit_many(z, "k", "z", {"m": K.Spec(3, 2, dims=c)})["m"]
        cut = model.transform(z, "z", "c").selectExpr(f"slice(z, 1, {c}) AS z", "c")
        assert got[method, c] == pytest.approx(E.silhouette(cut, "z", "c").first()["silhouette"], abs=1e-9)


def test_approaches_are_two_fits_and_as_before(small, monkeypatch):
    names = ("standard_pca", "whitened_pca", "zca_pca", "ratios_pca")
    fits, mixtures = counted(monkeypatch, SW, "fit_many"), counted(monkeypatch, SW, "fit_many_gmm")
    got = {r.approach: r for r in SW.approach_comparison(small, "k", "v", "label", names, 2, 3).collect()}
    assert len(fits) == len(mixtures) == 1 and set(got) == set(names)
    data = SW.scale_vector(small, "v", "standard").transform(small, "v", "v").select("k", "label", "v")
    for name in names:
        z = SW.APPROACHES[name](data, "k", "v", "label", 2)
        alone = {"kmeans": K.fit_many(z, "k", "v", {"m": K.Spec(3, 3)})["m"], "gmm": G.gmm(z, "k", "v", 3, "diag", 300)}
        best = E.best_by(SW.score_models(z, "v", "label", alone), "f1", "run").first()
        assert got[name].best_method == best["run"] and got[name].n_features == 2
        assert all(got[name][c] == pytest.approx(best[c], abs=1e-9) for c in E.METRICS)


def test_affinity_rounds_keep_no_tables(spark, monkeypatch):
    """Twenty-two rounds, over a checkpoint of the messages, against the messages of a complete graph."""
    from wideloom.operators import affinity as AP

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(14, 2)), rng.normal(size=(10, 2)) + 5])
    df = spark.createDataFrame(pa.table({"k": pa.array(np.arange(24)), "v": pa.array(list(x))}))
    monkeypatch.setattr(AP, "FEW", 100)  # several parts
    tables = counted(monkeypatch, AP, "cut_lineage")
    got = {r.k: r.exemplar for r in AP.affinity_propagation(df, "k", "v", 0.7, 22, 99, neighbors=23, preference=-9.0).collect()}
    assert len(tables) <= 3  # not one per round
    s = -((x[:, None] - x) ** 2).sum(2)
    np.fill_diagonal(s, -9.0)
    r, a = np.zeros((24, 24)), np.zeros((24, 24))
    for _ in range(22):
        v = a + s
        other = np.stack([np.delete(v, j, axis=1).max(axis=1) for j in range(24)], axis=1)
        r = 0.7 * r + 0.3 * (s - other)
        pos = np.maximum(r, 0)
        np.fill_diagonal(pos, 0)
        new = np.minimum(0, np.diag(r)[None] + pos.sum(0)[None] - pos)
        np.fill_diagonal(new, pos.sum(0))
        a = 0.7 * a + 0.3 * new
    assert got == dict(enumerate((a + r).argmax(axis=1).tolist()))


def test_affinity_with_repeated_keys(spark):
    from wideloom.operators import affinity as AP

    df = spark.createDataFrame([(i, [float(i % 2 * 9), i * 0.1]) for i in range(8)], "k bigint, v array<double>")
    got = AP.affinity_propagation(df.unionByName(df.limit(2)), "k", "v", 0.8, 30, 5, neighbors=3).collect()
    assert sorted(r.k for r in got) == list(range(8)) and {r.exemplar % 2 for r in got if r.k % 2} == {1}
