import heapq

import numpy as np
import pyarrow as pa
import pytest

from wideloom.operators import graph as G
from wideloom.operators import hierarchy as H
from wideloom.operators import manifold as MF
from wideloom.operators import neighbors as N
from wideloom.operators import spanning as SP


def frame(spark, x, first=0):
    return spark.createDataFrame(pa.table({"k": pa.array(np.arange(first, first + len(x))), "v": pa.array(list(x))}))


def clusters(n, p=12, centers=8, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(centers, p))[rng.integers(0, centers, n)] * 3 + rng.normal(size=(n, p))


def dense(x):
    d = np.sqrt(np.maximum(((x[:, None] - x[None]) ** 2).sum(2), 0))
    np.fill_diagonal(d, np.inf)
    return d


def near(x, k):
    return np.argsort(dense(x), axis=1, kind="stable")[:, :k]


def places(df, n, k="k"):
    got = df.orderBy(k).collect()
    assert len(got) == n
    return np.array([r["embedding"] for r in got])


def test_graph_recall_and_bounded_work(spark):
    """Pivot trees of many cells: the recall holds, and no unit of work exceeds a leaf."""
    x = clusters(3000)
    x[:50] = x[50]  # copies
    df = frame(spark, x).repartition(8)
    got = G.neighbor_graph(df, "k", "v", 10, leaf=128, rounds=3).persist()
    exact = N.nearest_neighbors(df, "k", "v", 10)
    assert G.recall(got, exact) >= 0.9
    rows = got.collect()
    assert len(rows) == 30000 and all(r.key != r.neighbor for r in rows)
    a, b = np.array([r.key for r in rows]), np.array([r.neighbor for r in rows])
    np.testing.assert_allclose([r.distance for r in rows], np.sqrt(((x[a] - x[b]) ** 2).sum(1)), atol=1e-5)
    for n in (10 ** 4, 10 ** 6, 10 ** 9):  # as many cells as rows need, from a few hundred pivots
        levels = G._levels(n, 1024)
        assert max(levels) <= G.MAX_PIVOTS and n / np.prod(levels) <= 1024


def test_small_graph_is_exact(spark, emb):
    got = {(r.key, r.neighbor) for r in G.neighbor_graph(emb, "vec_id", "v", 5).collect()}
    assert got == {(r.key, r.neighbor) for r in N.nearest_neighbors(emb, "vec_id", "v", 5).collect()}


def test_spectral_embedding_against_a_dense_solve(spark, emb, x):
    values, found = MF.spectral_embedding(emb, "vec_id", "v", 2, 14)
    a = np.zeros((len(x), len(x)))
    np.put_along_axis(a, near(x, 14), 1, axis=1)
    w = (a + a.T) / 2
    d = w.sum(1)
    e, u = np.linalg.eigh(np.eye(len(x)) - w / np.sqrt(np.outer(d, d)))
    want = u[:, 1:3] / np.sqrt(d)[:, None]
    want = want * np.sign(want[np.abs(want).argmax(0), [0, 1]])
    np.testing.assert_allclose(values, e[:3], atol=1e-7)
    np.testing.assert_allclose(places(found, len(x), "vec_id"), want, atol=1e-5)


def plain_paths(edges, source):
    out, heap = {source: 0.0}, [(0.0, source)]
    while heap:
        d, u = heapq.heappop(heap)
        for v, w in edges.get(u, []) if d <= out[u] else []:
            if d + w < out.get(v, np.inf):
                out[v] = d + w
                heapq.heappush(heap, (d + w, v))
    return out


def test_isomap_of_parts_that_are_far_apart(spark):
    """Links join the parts; paths are Dijkstra's; with every row a landmark it is classical scaling."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(25, 3)), rng.normal(size=(25, 3)) + 40, rng.normal(size=(10, 3)) - 60])
    df = frame(spark, x)
    both = MF.connected_edges(MF.neighbor_edges(df, "k", "v", 4), df, "k", "v")
    edges = {}
    for r in both.collect():
        edges.setdefault(r.i, []).append((r.j, r.distance))
    want = np.array([[plain_paths(edges, s)[t] for t in range(60)] for s in range(60)])
    marks = [3, 30, 55]
    got = {r.i: r.paths for r in MF.shortest_paths(both, df.selectExpr("k as i"), marks).collect()}
    np.testing.assert_allclose([got[i] for i in range(60)], want[:, marks], atol=1e-9)
    sq = want ** 2
    b = -0.5 * (sq - sq.mean(0) - sq.mean(1)[:, None] + sq.mean())
    e, u = np.linalg.eigh(b)
    full = u[:, [-1, -2]] * np.sqrt(e[[-1, -2]])
    found = places(MF.isomap(df, "k", "v", 2, 4), 60)
    np.testing.assert_allclose(found, full * np.sign((full * found).sum(0)), atol=1e-6)


def test_unreachable_nodes_have_no_path(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "i long, j long, distance double")
    got = MF.shortest_paths(edges, spark.range(1, 4).selectExpr("id as i"), [1]).orderBy("i").collect()
    assert [r.paths[0] for r in got] == [0.0, 1.0, None]


def test_lle_against_numpy(spark, emb, x):
    found = places(MF.locally_linear_embedding(emb, "vec_id", "v", 2, 5), len(x), "vec_id")
    nn = near(x, 5)
    w = np.zeros((len(x), len(x)))
    for i, js in enumerate(nn):
        z = x[js] - x[i]
        c = z @ z.T
        s = np.linalg.solve(c + 1e-3 * np.trace(c) * np.eye(5), np.ones(5))
        w[i, js] = s / s.sum()
    m = (np.eye(len(x)) - w).T @ (np.eye(len(x)) - w)
    want = np.linalg.eigh(m)[1][:, 1:3]
    np.testing.assert_allclose(found, want * np.sign(want[np.abs(want).argmax(0), [0, 1]]), atol=1e-8)


def test_lle_with_few_landmarks_and_copies(spark):
    x = clusters(300, 5, 3, 4)
    x[:20] = x[20]
    found = places(MF.locally_linear_embedding(frame(spark, x), "k", "v", 2, 6, max_landmarks=60), 300)
    assert np.isfinite(found).all() and (found[:20] == found[20]).all()


@pytest.mark.parametrize("block", [40])
def test_spanning_tree_against_prim(spark, block):
    x = clusters(150, 4, 5, 1)
    d = dense(x)
    inside, best, total = np.arange(150) == 0, d[0].copy(), 0.0
    for _ in range(149):
        j = np.where(inside, np.inf, best).argmin()
        total += best[j]
        inside[j] = True
        best = np.minimum(best, d[j])
    tree = SP.spanning_tree(frame(spark, x), "k", "v", block).collect()
    assert len(tree) == 149 and sum(r.distance for r in tree) == pytest.approx(total)


def test_single_linkage_against_the_dense_tree(spark):
    """More distinct rows than micro-clusters, with copies: still exact."""
    x = clusters(220, 3, 6, 2)
    x[:30] = x[30]
    d = dense(x)
    np.fill_diagonal(d, 0)
    for k in (7,):
        got = H.agglomerative(frame(spark, x), "k", "v", k, "single", max_micro=16).orderBy("k").collect()
        assert [r.cluster for r in got] == H.merge_tree(d, np.ones(220), k, "single").tolist()


def test_ward_against_the_dense_tree(spark):
    """More distinct rows than are merged on the driver, with copies, in several cells: still exact."""
    x = clusters(160, 3, 6, 5)
    x[:20] = x[20]
    d = dense(x)
    np.fill_diagonal(d, 0)
    for k, block in ((6, 30),):
        got = SP.ward_linkage(frame(spark, x), "k", "v", k, few=25, block=block).orderBy("k").collect()
        assert [r.cluster for r in got] == H.merge_tree(d, np.ones(160), k, "ward").tolist()


def test_only_shortened_paths_are_sent_on(spark, monkeypatch):
    links = [(0, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0), (0, 3, 9.0)]
    edges = spark.createDataFrame(links + [(b, a, d) for a, b, d in links], "i bigint, j bigint, distance double").persist()
    sent = []
    join = MF.join_groups

    def seen(df, groups, *args):
        sent.append({r["j"]: r["x"] for r in groups.collect()})
        return join(df, groups, *args)

    monkeypatch.setattr(MF, "join_groups", seen)
    got = MF.shortest_paths(edges, spark.createDataFrame([(i,) for i in range(4)], "i bigint"), [0, 3]).collect()
    far = float("inf")
    assert {r["i"]: r["paths"] for r in got} == {0: [0.0, 3.0], 1: [1.0, 2.0], 2: [2.0, 1.0], 3: [3.0, 0.0]}
    assert sent[0] == {0: [0.0, far], 3: [far, 0.0]} and sent[1][0] == [far, 9.0] and sent[1][1] == [1.0, far]


def test_meetings_report_only_what_may_be_kept():
    batch = pa.RecordBatch.from_pydict({
        "center": [0] * 4, "key": [0, 1, 2, 3], "vec": [[0.0], [1.0], [3.0], [7.0]], "reach": [1.0, 2.0, float("inf"), 0.5]})
    found = {(a, b) for out in G._meeting_edges(3)(iter([batch])) for a, b in zip(out["key"].to_pylist(), out["neighbor"].to_pylist())}
    assert found == {(0, 1), (1, 0), (1, 2), (2, 0), (2, 1), (2, 3)}


def test_edges_are_exact_beyond_one_leaf(spark):
    x = np.random.default_rng(3).normal(size=(2500, 24))  # noise, where the approximate graph misses edges
    got = {(r.key, r.neighbor) for r in MF.neighbor_edges(frame(spark, x).repartition(4), "k", "v", 5).collect()}
    assert got == {(i, int(j)) for i, near_i in enumerate(near(x, 5)) for j in near_i}


def test_edges_of_repeated_keys_count_a_neighbour_once(spark):
    x = clusters(60)
    both = frame(spark, x).unionByName(frame(spark, x[:6])).unionByName(spark.createDataFrame([(77, None)], "k bigint, v array<double>"))
    got = {}
    for r in MF.neighbor_edges(both.repartition(3), "k", "v", 4).collect():
        got.setdefault(r.key, []).append((r.distance, r.neighbor))
    d = dense(x)
    d[np.arange(6), np.arange(6)] = 0.0  # a copy of the row is a row
    assert set(got) == set(range(60))
    assert all({j for _, j in found} == set(np.argsort(d[i])[:4].tolist()) and len(found) == 4 for i, found in got.items())
