"""Clustering operators against brute force on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from wideloom.operators import evaluate
from wideloom.operators import affinity as AP
from wideloom.operators import dbscan as DB
from wideloom.operators import gmm as G
from wideloom.operators import hierarchy as H
from wideloom.operators import kmeans as K
from wideloom.operators import meanshift as MS
from wideloom.operators import neighbors as N
from wideloom.operators.components import connected_components
from wideloom.plans import sweeps as SW


def frame(spark, m, y=None):
    return spark.createDataFrame(
        [(i, [float(v) for v in r], int(y[i]) if y is not None else 0) for i, r in enumerate(m)],
        "vec_id bigint, v array<double>, label int")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    m = np.concatenate([rng.normal(c, 0.3, size=(40, 2)) for c in ((0, 0), (4, 0), (0, 5))])
    y = np.repeat([0, 1, 2], 40)
    return frame(spark, m, y).persist(), m, y


def same_partition(a, b):
    pairs = set(zip(a, b))
    return len(pairs) == len(set(a)) == len(set(b))


def test_kmeans_finds_blobs(blobs):
    df, m, y = blobs
    model = K.kmeans(df, "vec_id", "v", 3)
    got = rows(model.transform(df, "v"), "vec_id", "cluster")
    assert same_partition(got, y)
    assert np.isclose(model.inertia, sum(((m[got == j] - m[got == j].mean(0)) ** 2).sum() for j in range(3)))
    assert np.isclose(model.total_cost(df, "v"), model.inertia)


def test_kmeans_refills_an_empty_cluster(blobs):
    df, _, y = blobs
    start = np.array([[0.0, 0.0], [4.0, 0.0], [500.0, 500.0]])
    got = rows(K.kmeans(df, "vec_id", "v", 3, init=start).transform(df, "v"), "vec_id", "cluster")
    assert len(set(got)) == 3


@pytest.mark.parametrize("metric", K.METRICS)
def test_enhanced_kmeans(spark, metric):
    rng = np.random.default_rng(4)
    m = np.concatenate([rng.normal((3, 0), 0.2, (40, 2)), rng.normal((0, 3), 0.2, (40, 2))])
    df = frame(spark, m)
    model = K.enhanced_kmeans(df, "vec_id", "v", 2, metric, n_init=3, max_iter=30)
    got = rows(model.transform(df, "v"), "vec_id", "cluster")
    if metric != "rbf":
        assert same_partition(got, np.repeat([0, 1], 40))


def test_histogram_medians_equal_numpy(emb, x):
    c = x[:3].copy()
    r = K._Run("m", K.Spec(3, enhanced=True), 1, c, None)
    span = K._span(emb, "v")
    K._assign_stats(emb, "v", [r], span, 512)
    got = K._medians(emb, "v", [r], span, 512)[id(r)]
    a = ((x[:, None] - c) ** 2).sum(2).argmin(1)
    assert np.allclose(got, [np.median(x[a == j], axis=0) for j in range(3)], rtol=0, atol=0)


def test_enhanced_step_matches_reference_arithmetic(spark):
    """Two rounds by hand: median update, then decayed step plus momentum."""
    rng = np.random.default_rng(5)
    m = rng.normal(size=(60, 2)) + np.repeat([[0, 0], [3, 3]], 30, axis=0)
    df, c = frame(spark, m), np.array([[0.5, 0.0], [2.0, 2.0]])
    spec = K.Spec(2, enhanced=True, init=c)
    got = K.fit_many(df, "vec_id", "v", {"m": spec}, max_iter=2, tol=0.0)["m"].centers
    a = ((m[:, None] - c) ** 2).sum(2).argmin(1)
    c1 = np.array([np.median(m[a == j], axis=0) for j in range(2)])
    a = ((m[:, None] - c1) ** 2).sum(2).argmin(1)
    med = np.array([np.median(m[a == j], axis=0) for j in range(2)])
    assert np.allclose(got, c1 + (med - c1) / 1.1 + 0.1 * (c1 - c), atol=1e-7)


def test_weights_must_fit(blobs):
    with pytest.raises(ValueError):
        K.enhanced_kmeans(blobs[0], "vec_id", "v", 2, weights=[1.0, 1.0, 1.0])


def test_seeding_draws_by_squared_distance(spark):
    # One far row must almost always become the second center.
    m = np.concatenate([np.zeros((50, 1)) + np.arange(50)[:, None] * 1e-3, [[100.0]]])
    df = frame(spark, m)
    models = K.fit_many(df, "vec_id", "v", {str(s): K.Spec(2, 1, seed=s) for s in range(20)}, max_iter=1)
    assert sum(abs(c.centers).max() > 90 for c in models.values()) >= 19


@pytest.mark.parametrize("kind", G.COVARIANCES)
def test_gmm_likelihood_rises(blobs, kind):
    df, m, y = blobs
    g = G.gmm(df, "vec_id", "v", 3, kind, max_iter=30, tol=1e-6, n_init=4)  # one start may be a poor optimum
    assert all(b >= a - 1e-9 for a, b in zip(g.history, g.history[1:]))
    assert same_partition(rows(g.transform(df, "v"), "vec_id", "cluster"), y)
    p = rows(df.withColumn("p", g.predict_proba("v")), "vec_id", "p")
    assert np.allclose(p.sum(1), 1)


def test_gmm_round_matches_numpy(blobs):
    df, m, _ = blobs
    g0 = G.gmm(df, "vec_id", "v", 2, max_iter=1, init="random")
    g1 = G.gmm(df, "vec_id", "v", 2, max_iter=2, init="random")

    def density(mu, cov):
        d = m - mu
        return np.exp(-0.5 * (d @ np.linalg.inv(cov) * d).sum(1)) / (2 * np.pi * np.sqrt(np.linalg.det(cov)))

    joint = np.stack([w * density(mu, c) for w, mu, c in zip(g0.weights, g0.means, g0.covariances)], axis=1)
    r = joint / joint.sum(1, keepdims=True)
    assert np.isclose(g1.log_likelihood, np.log(joint.sum(1)).mean())
    mu = r.T @ m / r.sum(0)[:, None]
    assert np.allclose(g1.means, mu)
    cov = np.stack([((m - mu[j]) * r[:, [j]]).T @ (m - mu[j]) / r[:, j].sum() + 1e-6 * np.eye(2) for j in range(2)])
    assert np.allclose(g1.covariances, cov, atol=1e-10)


def test_component_search_prefers_three(blobs):
    n, table, _ = G.best_component_count(blobs[0], "vec_id", "v", 5, n_runs=2)
    assert n == 3 and table.count() == 5


def brute_dbscan(m, eps, least):
    near = N.pair_distances(m, m) <= eps
    core, label, c = near.sum(1) >= least, np.full(len(m), -1), 0
    for i in range(len(m)):
        if not core[i] or label[i] >= 0:
            continue
        todo, label[i] = [i], c
        while todo:
            u = todo.pop()
            if core[u]:
                for v in np.flatnonzero(near[u]):
                    if label[v] < 0:
                        label[v] = c
                        todo.append(v)
        c += 1
    return label


@pytest.mark.parametrize("block", [2048, 60])
def test_dbscan_equals_brute_force(emb, x, block):
    """Several settings at once, with copies, in one block and in many cells and blocks."""
    copies = emb.where("vec_id < 50").withColumn("vec_id", F.col("vec_id") + 1000)
    both = np.concatenate([x, x[:50]])
    settings = [(1.1, 5), (1.16, 4), (1.2, 6)]
    got = DB.dbscan_grid(emb.unionByName(copies), "vec_id", "v", settings, block=block).orderBy("run", "key").collect()
    got = np.array([r["cluster"] for r in got]).reshape(len(settings), -1)
    for g, s in zip(got, settings):
        assert np.array_equal(g, brute_dbscan(both, *s))


def test_dbscan_with_one_hot_vector(spark):
    """A third of all rows share one vector."""
    rng = np.random.default_rng(6)
    m = np.concatenate([np.zeros((100, 2)), rng.uniform(-3, 3, (200, 2))])
    got = rows(DB.dbscan(frame(spark, m), "vec_id", "v", 0.5, 4), "vec_id", "cluster")
    assert np.array_equal(got, brute_dbscan(m, 0.5, 4))


@pytest.mark.parametrize("block", [2048, 50])
def test_nearest_neighbors(emb, x, block):
    d = N.pair_distances(x, x)
    np.fill_diagonal(d, np.inf)
    got = N.nearest_neighbors(emb, "vec_id", "v", 3, block=block).orderBy("key", "distance").collect()
    assert np.allclose(np.array([r["distance"] for r in got]).reshape(-1, 3), np.sort(d, axis=1)[:, :3])


def test_components(spark):
    rng = np.random.default_rng(7)
    edges = [(0, int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(1, i, i + 1) for i in range(40)]
    got = connected_components(spark.createDataFrame(edges, "run int, u bigint, v bigint"))
    root = {(r["run"], r["node"]): r["root"] for r in got.collect()}
    assert all(root[(1, i)] == 0 for i in range(41))
    parent = list(range(60))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for _, a, b in edges[:45]:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    for (run, n), r in root.items():
        if run == 0:
            assert r == find(n)


def brute_agglomerative(d, k, linkage):
    groups = [[i] for i in range(len(d))]
    fn = {"single": np.min, "complete": np.max, "average": np.mean}[linkage]
    while len(groups) > k:
        best = min(((fn(d[np.ix_(a, b)]), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
        groups[best[1]] += groups.pop(best[2])
    out = np.zeros(len(d), int)
    for c, g in enumerate(groups):
        out[g] = c
    return out


@pytest.mark.parametrize("linkage", ["single", "complete", "average"])
def test_agglomerative_is_exact_on_few_rows(spark, x, linkage):
    m = x[:40]
    got = rows(H.agglomerative(frame(spark, m), "vec_id", "v", 4, linkage), "vec_id", "cluster")
    assert np.array_equal(got, brute_agglomerative(N.pair_distances(m, m), 4, linkage))


def test_ward_and_micro_clusters(blobs):
    df, m, y = blobs
    assert same_partition(rows(H.agglomerative(df, "vec_id", "v", 3, "ward"), "vec_id", "cluster"), y)
    assert same_partition(rows(H.agglomerative(df, "vec_id", "v", 3, "ward", max_micro=20), "vec_id", "cluster"), y)


def test_ensemble_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    t = np.stack([rng.integers(0, 2, 80), rng.integers(0, 3, 80), rng.integers(-1, 2, 80)], axis=1)
    w = np.array([0.5, 0.35, 0.15])
    df = spark.createDataFrame([(i, *map(int, r)) for i, r in enumerate(t)], "vec_id bigint, a int, b int, c int")
    got = rows(H.ensemble(df, "vec_id", ["a", "b", "c"], dict(zip("abc", w)), 3), "vec_id", "cluster")
    co = sum(wi * ((t[:, [j]] == t[None, :, j]) & (t[:, [j]] != -1)) for j, wi in enumerate(w))
    want = brute_agglomerative(1 - co, 3, "average")

    def mean_inside(label):
        return sum(co[np.ix_(label == c, label == c)].mean() * (label == c).mean() for c in set(label))

    assert same_partition(got, want) or np.isclose(mean_inside(got), mean_inside(want), atol=0.02)


def test_ensemble_drops_a_noisy_density_clustering(spark):
    df = spark.createDataFrame([(i, i % 2, -1) for i in range(20)], "vec_id bigint, a int, dbscan int")
    got = rows(H.ensemble(df, "vec_id", ["a", "dbscan"], {"a": 1.0, "dbscan": 1.0}, 2), "vec_id", "cluster")
    assert same_partition(got, np.arange(20) % 2)


def test_mean_shift_equals_brute_force(blobs):
    df, m, y = blobs
    got, modes = MS.mean_shift(df, "vec_id", "v", bandwidth=0.8)
    p = m.copy()
    for _ in range(300):
        w = np.exp(-0.5 * (N.pair_distances(p, m) / 0.8) ** 2)
        new = w @ m / w.sum(1, keepdims=True)
        done = np.linalg.norm(new - p, axis=1).max() < 1e-3
        p = new
        if done:
            break
    _, want = MS.merge_modes(p, 0.4)
    assert same_partition(rows(got, "vec_id", "cluster"), want) and len(modes) == len(set(want))


def test_affinity_equals_dense_messages(spark, x):
    m = x[:40]
    got = rows(AP.affinity_propagation(frame(spark, m), "vec_id", "v", max_iter=6, neighbors=39), "vec_id", "exemplar")
    s = -N.pair_distances(m, m) ** 2
    np.fill_diagonal(s, 0)
    np.fill_diagonal(s, np.median(s))
    a, r, n = np.zeros_like(s), np.zeros_like(s), len(m)
    for _ in range(6):
        old, t = r.copy(), a + s
        r = np.array([[s[i, k] - np.delete(t[i], k).max() for k in range(n)] for i in range(n)])
        r = 0.5 * old + 0.5 * r
        old, p = a.copy(), np.maximum(r, 0)
        col = p.sum(0) - np.diag(p)
        a = np.array([[col[k] if i == k else min(0, r[k, k] + col[k] - p[i, k]) for k in range(n)] for i in range(n)])
        a = 0.5 * old + 0.5 * a
    assert np.array_equal(got, (a + r).argmax(1))


def test_optimal_k(blobs):
    assert SW.optimal_k(blobs[0], "vec_id", "v", 5, n_init=3)[0] == 3
    assert SW.optimal_k(blobs[0], "vec_id", "v", 6, "elbow", n_init=3)[0] in (3, 4, 5)


def test_sweep_prefixes_equal_separate_fits(emb):
    from wideloom.operators import reduce as R

    z = R.pca(emb, "v", 6).transform(emb, "v", "z")
    many = K.fit_many(z, "vec_id", "z", {str(c): K.Spec(3, 2, dims=c) for c in (2, 4)})
    for c in (2, 4):
        alone = K.fit_many(z.withColumn("z", F.slice("z", 1, c)), "vec_id", "z", {"m": K.Spec(3, 2)})["m"]
        assert np.allclose(many[str(c)].centers, alone.centers)


def test_searches_return_scored_rows(blobs):
    df, _, _ = blobs
    found = SW.dbscan_search(df, "vec_id", "v", "label", [0.5, 1.0], [4]).collect()
    assert max(r["ari"] for r in found) > 0.9
    _, table = SW.many_algorithms(df, "vec_id", "v", "label", 3, 0.6, 4, max_iter=10, neighbors=15)
    best = {r["run"]: r["ari"] for r in table.collect()}
    assert best["kmeans"] == 1.0 and best["agglomerative_ward"] == 1.0 and set(best) == set(SW.ALGORITHMS)


def test_alignment_by_number_of_clusters(spark):
    cells = spark.createDataFrame(
        [("a", c, k, 5 + (c == (k + 3) % 12) * 100) for c in range(12) for k in range(12)] +
        [("b", c, k, 5 + (c == k % 2) * 50) for c in range(2) for k in range(5)], "run string, label int, cluster int, rows long")
    got = {(r["run"], r["cluster"]): r["mapped"] for r in evaluate.align(cells, ["run"]).collect()}
    assert all(got["a", k] == (k + 3) % 12 for k in range(12))  # one-to-one beyond eight clusters too
    assert all(got["b", k] == k % 2 for k in range(5))  # more clusters than classes: majority
    flat = spark.createDataFrame([(0, 0, 9), (0, 1, 8), (1, 0, 1), (1, 1, 7)], "label int, cluster int, rows long")
    assert {r["cluster"]: r["mapped"] for r in evaluate.align(flat).collect()} == {0: 0, 1: 1}
    assert {r["cluster"]: r["mapped"] for r in evaluate.align(flat, alignment="majority").collect()} == {0: 0, 1: 0}
