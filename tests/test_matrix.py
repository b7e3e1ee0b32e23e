"""Reductions and whitening against NumPy."""

import numpy as np
import pytest

from conftest import rows
from wideloom.operators import features as FT
from wideloom.operators import hierarchy as H
from wideloom.operators import reduce as R
from wideloom.operators import rowsums
from wideloom.plans import steps as ST


def same_up_to_sign(a, b, tol=1e-8):
    s = np.sign((a * b).sum(axis=0))
    return np.abs(a - b * s).max() < tol


def scores(df, model, out="z"):
    return rows(model.transform(df, "v", out), "vec_id", out)


def test_gram_matches_numpy(emb, x):
    g = R.gram(emb, "v")
    assert g.n == len(x)
    assert np.allclose(g.mean, x.mean(0), atol=1e-14) and np.allclose(g.cov, np.cov(x.T), atol=1e-14)


def test_gram_keeps_precision_under_a_large_offset(emb, x):
    from wideloom.functions.vectors import matrix_column

    far = emb.withColumn("v", matrix_column(lambda m: m + 1e6, "v"))
    assert np.allclose(R.gram(far, "v").cov, np.cov(x.T), atol=1e-8)


def test_sums_through_the_reducer_tree(emb, x, monkeypatch):
    monkeypatch.setattr(rowsums, "DIRECT", 0)
    monkeypatch.setattr(rowsums, "CHUNK", 100)
    wide = emb.repartition(7)
    total, = rowsums.sum_rows(wide, ["v"], lambda m: [m.T @ m])
    assert np.allclose(total, x.T @ x)
    low, at = rowsums.sum_rows(wide, ["v"], lambda m: (np.array([m[:, 0].min()]), m[[m[:, 0].argmin()]]), rowsums.keep_smallest)
    assert low[0] == x[:, 0].min() and (at[0] == x[x[:, 0].argmin()]).all()


def test_one_merged_sum_reaches_the_driver(emb, x, monkeypatch):
    """However many tasks there are: partial sums of more than a few bytes are merged by reducers."""
    taken = []
    for name in ("collect", "toLocalIterator"):
        def counted(self, *args, real=getattr(type(emb), name), **kwargs):
            got = list(real(self, *args, **kwargs))
            taken.append(len(got))
            return got

        monkeypatch.setattr(type(emb), name, counted)
    for direct in (64, 5):
        monkeypatch.setattr(rowsums, "DIRECT", direct)
        for merge, want in ((rowsums.add, x.sum(0)), (lambda a, b: [np.maximum(a[0], b[0])], x.max(0))):
            taken.clear()
            got, = rowsums.sum_rows(emb.repartition(23), ["v"], lambda m: [m.sum(0) if merge is rowsums.add else m.max(0)], merge)
            assert np.allclose(got, want) and taken == [1]


def test_pca(emb, x):
    m = R.pca(emb, "v", 5)
    c = x - x.mean(0)
    w, v = np.linalg.eigh(np.cov(x.T))
    w, v = w[::-1], v[:, ::-1]
    assert same_up_to_sign(scores(emb, m), c @ v[:, :5])
    assert np.allclose(m.ratio, w[:5] / w.sum())
    assert np.allclose(np.cov(scores(emb, R.pca(emb, "v", 20, True)).T), np.eye(20), atol=1e-9)
    assert np.allclose(scores(emb, R.double_pca(emb, "v", 5)), scores(emb, m))
    assert np.allclose(scores(emb, R.pca(emb, "v", 20).first(5)), scores(emb, m))


def test_component_count_by_share():
    ratio = np.array([0.5, 0.3, 0.15, 0.05])
    assert R.components_for(ratio, 0.79) == 2 and R.components_for(ratio, 0.95 - 1e-9) == 3
    assert R.components_for(ratio, 1.5) == 4


@pytest.mark.parametrize("method", ["zca", "cholesky", "mahalanobis", "adaptive"])
def test_whitening_gives_the_identity(emb, method):
    z = scores(emb, R.whiten(emb, "v", method))
    assert np.allclose(np.cov(z.T), np.eye(64), atol=1e-3)


def test_hybrid_edges(emb):
    g = R.gram(emb, "v")
    assert np.allclose(R.hybrid_matrix(g.cov, 1.5, 0.7), R.hybrid_matrix(g.cov, 1.0, 0.7))
    assert np.allclose(R.hybrid_matrix(g.cov, -1.0, 1.0), R.hybrid_matrix(g.cov, 0.0, 1.0))


def test_truncated_svd(emb, x):
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    m = R.truncated_svd(emb, "v", 4)
    assert same_up_to_sign(scores(emb, m), x @ vt[:4].T)
    t = x @ vt[:4].T
    assert np.allclose(m.ratio, t.var(0) / x.var(0).sum())


def test_polynomial_pca(emb, x):
    small = x[:, :6]
    from pyspark.sql import functions as F

    df = emb.withColumn("v", F.slice("v", 1, 6))
    p = R.poly_expand(6, 2)(small)
    assert p.shape[1] == 6 + 21
    c = p - p.mean(0)
    w, v = np.linalg.eigh(np.cov(p.T))
    assert same_up_to_sign(scores(df, R.polynomial_pca(df, "v", 3)), c @ v[:, ::-1][:, :3])


@pytest.mark.parametrize("kernel", ["rbf", "poly", "sigmoid", "cosine", "linear"])
def test_kernel_pca_is_exact_with_all_rows_as_landmarks(emb, x, kernel):
    gamma = 1 / 64
    k = R.kernel_matrix(x, x, kernel, gamma)
    n = len(x)
    j = np.eye(n) - np.ones((n, n)) / n
    w, v = np.linalg.eigh(j @ k @ j)
    w, v = w[::-1][:4], v[:, ::-1][:, :4]
    assert same_up_to_sign(scores(emb, R.kernel_pca(emb, "vec_id", "v", 4, kernel)), v * np.sqrt(w), 1e-6)


def test_kernel_pca_on_fewer_landmarks_approximates(emb):
    # A decaying spectrum: the embeddings' own leading components are nearly tied.
    from wideloom.functions.vectors import matrix_column

    df = emb.withColumn("v", matrix_column(lambda m: m * 0.5 ** np.arange(64), "v"))
    full = scores(df, R.kernel_pca(df, "vec_id", "v", 2, "linear"))
    few = scores(df, R.kernel_pca(df, "vec_id", "v", 2, "linear", max_landmarks=300))
    q, _ = np.linalg.qr(full - full.mean(0))
    p, _ = np.linalg.qr(few - few.mean(0))
    assert np.linalg.svd(q.T @ p)[1].min() > 0.95


def test_ica_recovers_sources(spark):
    rng = np.random.default_rng(0)
    s = np.stack([rng.uniform(-1, 1, 2000), rng.laplace(size=2000), np.sign(rng.normal(size=2000))], axis=1)
    mixed = s @ rng.normal(size=(3, 3)).T
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(mixed)], "vec_id bigint, v array<double>")
    z = scores(df, R.ica(df, "v", 3))
    c = np.abs(np.corrcoef(z.T, s.T)[:3, 3:])
    assert (c.max(axis=0) > 0.98).all()
    assert np.allclose(z.std(0), 1, atol=1e-6)


def test_nmf_recovers_a_low_rank_product(spark):
    rng = np.random.default_rng(1)
    a = rng.uniform(size=(200, 3)) @ rng.uniform(size=(3, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(a)], "vec_id bigint, v array<double>")
    f = R.nmf(df, "v", 3, max_iter=60, tol=1e-9)
    assert f.losses[-1] < 1e-3 * (a ** 2).sum() and (f.components >= 0).all()
    w = scores(df, f)
    assert (w >= 0).all() and np.allclose(w @ f.components, a, atol=0.15)


def test_dictionary_learning_improves_and_is_sparse(emb):
    f = R.dictionary_learning(emb, "v", 5, 0.3, max_iter=8)
    assert f.losses[-1] < f.losses[0] and (np.linalg.norm(f.components, axis=1) <= 1 + 1e-9).all()
    assert (scores(emb, f) == 0).any()


def test_random_projection_is_seeded_and_scaled(emb, x):
    a, b = scores(emb, R.random_projection(emb, "v", 20)), scores(emb, R.random_projection(emb, "v", 20))
    assert np.array_equal(a, b)
    assert 0.8 < (a ** 2).sum() / (x ** 2).sum() < 1.25


def test_feature_agglomeration(emb, x):
    from wideloom.operators.neighbors import pair_distances

    m = H.feature_agglomeration(emb, "v", 10, "average")
    want = H.merge_tree(pair_distances(x.T, x.T), np.ones(64), 10, "average")
    assert np.array_equal(m.groups, want)
    z = scores(emb, m)
    for j in range(10):
        assert np.allclose(z[:, j], x[:, want == j].mean(axis=1))


def test_f_tail():
    # Closed forms: F(2, d) has tail (1 + 2 f / d)^(-d / 2).
    f, d = np.array([0.5, 1.0, 3.0]), np.array([10.0, 20.0, 7.0])
    assert np.allclose(FT.f_tail(f, np.array([2.0] * 3), d), (1 + 2 * f / d) ** (-d / 2), rtol=1e-10)


def test_centrality_of_a_star():
    c = FT.eigenvector_centrality(4, [(0, 1, 1.0), (0, 2, 1.0), (0, 3, 1.0)])
    assert c.argmax() == 0 and np.allclose(c[1:], c[1], atol=1e-6) and np.isclose(c[0] / c[1], np.sqrt(3), atol=1e-3)
    assert np.allclose(FT.eigenvector_centrality(3, []), 1 / np.sqrt(3))


def test_select_from_model_and_percentile(spark):
    imp = np.array([0.1, 0.4, 0.2, 0.3])
    assert FT.select_from_model(imp, "mean") == [1, 3]
    assert FT.select_from_model(imp, None, 3) == [1, 2, 3]
    t = spark.createDataFrame([(i, float(s)) for i, s in enumerate([1, 5, 5, 2, 5, 0, 0, 0, 0, 0])], "i int, s double")
    assert FT.best_percentile(t, "s", 20) == [1, 2]


def test_forest_finds_the_informative_feature(spark):
    rng = np.random.default_rng(2)
    yy = rng.integers(0, 2, 300)
    xx = rng.normal(size=(300, 6))
    xx[:, 4] += 3 * yy
    df = spark.createDataFrame([(int(c), [float(v) for v in r]) for c, r in zip(yy, xx)], "label int, v array<double>")
    assert FT.forest_importance(df, "v", "label", 20).argmax() == 4


def test_steps_reject_unknown_names_and_missing_labels(emb):
    with pytest.raises(ValueError):
        ST.run_steps(emb, "vec_id", "v", [{"name": "nothing"}])
    with pytest.raises(ValueError):
        ST.run_steps(emb, "vec_id", "v", [{"name": "select_percentile"}])


@pytest.mark.parametrize("how", ["standard", "robust", "minmax", "maxabs"])
def test_vector_scaling(emb, x, how):
    z = scores(emb, ST.scale_vector(emb, "v", how))
    want = {"standard": (x - x.mean(0)) / x.std(0), "minmax": (x - x.min(0)) / (x.max(0) - x.min(0)),
            "maxabs": x / np.abs(x).max(0),
            "robust": (x - np.median(x, 0)) / (np.percentile(x, 75, 0) - np.percentile(x, 25, 0))}[how]
    assert np.allclose(z, want)


def test_composed_reductions_have_unit_covariance(emb):
    for fn in (ST.ensemble_reduction, ST.auto_features):
        z = rows(fn(emb.select("vec_id", "v"), "vec_id", "v", 8), "vec_id", "v")
        assert z.shape[1] == 8 and np.allclose(np.cov(z.T), np.eye(8), atol=1e-6)


def test_transform_works_on_a_stream(spark, emb, tmp_path, x):
    from wideloom.streaming.score import score_stream

    emb.select("vec_id", "v").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("vec_id bigint, v array<double>").parquet(str(tmp_path / "in"))
    q = score_stream(stream, [R.pca(emb, "v", 3)], "v").writeStream.format("memory").queryName("scored").start()
    q.processAllAvailable()
    q.stop()
    assert np.allclose(rows(spark.table("scored"), "vec_id", "out0"), scores(emb, R.pca(emb, "v", 3)))
