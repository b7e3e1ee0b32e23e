import numpy as np
import pyarrow as pa

from wideloom.operators import reduce as R
from wideloom.operators.information import digamma, neighbor_mutual_information


def frame(spark, x, y=None):
    cols = {"k": pa.array(np.arange(len(x))), "v": pa.array(list(x))}
    return spark.createDataFrame(pa.table(cols | ({} if y is None else {"y": pa.array(y)})))


def test_sketch_has_the_leading_variance(spark, emb, x):
    exact = R.polynomial_pca(emb, "v", 5)
    found = R.sketched_polynomial_pca(emb, "v", 5, passes=3)
    assert found.ratio.sum() >= 0.95 * exact.ratio.sum() and (found.ratio <= exact.ratio * (1 + 1e-9)).all()
    z = found.transform(emb, "v", "z").orderBy("vec_id").collect()
    z = np.array([r["z"] for r in z])
    np.testing.assert_allclose(z.mean(0), 0, atol=1e-9)
    np.testing.assert_allclose(np.cov(z.T), np.diag(found.explained), atol=1e-9 * found.explained[0])


def test_sketch_finds_a_low_rank_exactly(spark):
    rng = np.random.default_rng(0)
    t = rng.normal(size=(200, 1))
    x = t @ rng.normal(size=(1, 20))  # its squares have rank one, too
    df = frame(spark, x)
    for degree, only in ((2, False), (2, True), (3, False)):
        exact, found = R.polynomial_pca(df, "v", 2, degree, only), R.sketched_polynomial_pca(df, "v", 2, degree, only)
        np.testing.assert_allclose(found.explained, exact.explained, rtol=1e-8)
        np.testing.assert_allclose(np.abs((found.matrix * exact.matrix).sum(0)), 1, atol=1e-6)


def test_sketch_at_full_width(spark):
    """1444 features: a million terms, without their Gram matrix of 8 TB."""
    x = np.random.default_rng(1).normal(size=(24, 1444))
    found = R.sketched_polynomial_pca(frame(spark, x).coalesce(1), "v", 2, extra=2, passes=1)
    assert found.matrix.shape == (1444 * 1447 // 2, 2) and np.isfinite(found.explained).all()


def plain_information(x, y, k=3):
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        own = np.sort(np.abs(x[y == y[i]] - x[i]))[1:]
        kk = min(k, len(own))
        near = np.abs(x - x[i])
        m = ((near < own[kk - 1]) | (x == x[i])).sum()
        total += digamma([kk])[0] - digamma([len(own) + 1])[0] - digamma([m])[0]
    return max(0.0, digamma([len(x)])[0] + total / len(x))


def test_neighbor_information_with_ties(spark):
    rng = np.random.default_rng(2)
    y = np.concatenate([rng.integers(0, 3, 119), [9]])  # a class of one row
    x = np.stack([rng.normal(size=120) + y, rng.integers(0, 6, 120) + 0.0, np.zeros(120), np.where(rng.random(120) < 0.4, 0.0, rng.normal(size=120))], 1)
    got = {r.i: r.mi for r in neighbor_mutual_information(frame(spark, x, y).repartition(6), "v", "y").collect()}
    want = [plain_information(x[:, c], y) for c in range(4)]
    np.testing.assert_allclose([got[c] for c in range(4)], want, atol=1e-9)


def test_digamma():
    n = np.arange(1, 50)
    np.testing.assert_allclose(digamma(n), np.concatenate([[0], np.cumsum(1 / n[:-1])]) - 0.5772156649015329, atol=1e-12)
