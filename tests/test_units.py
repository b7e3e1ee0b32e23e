"""Range joins in units of bounded size: what travels, and what a unit computes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wideloom.operators import dbscan as DB
from wideloom.operators import neighbors as N
from wideloom.operators import spanning as SP


def frame(spark, m):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(m)], "k bigint, v array<double>")


def test_a_row_travels_to_few_units(spark):
    """Rows that meet all of 60 cells are sent to a few parts, and every pair is met once."""
    m = np.random.default_rng(1).normal(size=(600, 16))
    df = frame(spark, m)

    def seen(q, d, *tiles):
        met = sum((t.stop - t.start) * sum(hi - lo for lo, hi in spans) for t, spans in tiles[0]) if tiles else 0
        return {"rows": np.array([len(q["key"]) + len(d["key"])]), "pairs": np.array([met])}

    units = N.block_join(df, "k", "v", N.choose_pivots(df, "k", "v", 600, 10), F.lit(1e300), seen, "rows bigint, pairs bigint", block=10)
    rows, pairs = units.agg(F.sum("rows"), F.sum("pairs")).first()
    assert pairs == 600 * 600
    assert rows <= 600 * 20


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e6, 1), (0, 1e-8), (0, 1e30), (0, 0)])
def test_close_pairs_equal_brute_force(shift, scale):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(40, 8)) * scale + shift, rng.normal(size=(300, 8)) * scale + shift
    b[:20] = a[:20]
    exact = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    for limit in (np.full(40, np.quantile(exact, 0.01)), np.quantile(exact, 0.3, axis=1), np.full(40, 1e300)):
        found = list(N.Residents({"vec": b}).close(a, limit * (1 + 1e-6), [(0, 100), (100, 300)]))
        got = np.zeros(exact.shape, bool)
        for i, j, d in found:
            got[i, j] = True
            assert np.allclose(d, exact[i, j], rtol=1e-6, atol=1e-6 * scale)
        assert got[exact < limit[:, None] * (1 - 1e-3)].all()
        assert not got[exact > limit[:, None] * (1 + 1e-3)].any()


def test_nearest_links_of_small_and_large_parts(spark):
    """Two thirds of the rows are one part; only the others search, and the tree is whole."""
    rng = np.random.default_rng(3)
    m = np.concatenate([rng.normal(size=(80, 3)) * 0.1, rng.normal(size=(40, 3)) + 5])
    points = frame(spark, m).select(F.col("k").alias("i"), F.col("v").alias("vec"),
                                    F.when(F.col("k") < 80, 0).otherwise(F.col("k")).cast("bigint").alias("root"))
    found = SP._shortest(points, 120, 10).collect()
    d = N.pair_distances(m, m)
    root = np.where(np.arange(120) < 80, 0, np.arange(120))
    d[root[:, None] == root[None, :]] = np.inf
    assert {r["root"] for r in found} == set(range(80, 120))
    assert all(np.isclose(r["distance"], d[r["root"]].min()) for r in found)


def test_forest_labels_components():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 200, 150), rng.integers(0, 200, 150)
    want = np.arange(200)
    while True:
        new = want.copy()
        np.minimum.at(new, a, want[b])
        np.minimum.at(new, b, want[a])
        if (new == want).all():
            break
        want = new
    assert np.array_equal(DB._forest(200, a, b), want)


def test_ward_compares_all_pairs_at_once_and_ends_on_the_driver(spark, monkeypatch):
    from wideloom.operators import hierarchy as H

    m = np.random.default_rng(5).normal(size=(600, 4))
    n = np.ones(600)
    want = H.merge_tree(N.pair_distances(m, m), n, 6, "ward").tolist()
    passes = []
    join = SP.block_join
    monkeypatch.setattr(SP, "block_join", lambda *a, **k: passes.append(len(a[3])) or join(*a, **k))
    got = H.agglomerative(frame(spark, m), "k", "v", 6, "ward", max_micro=16).orderBy("k").collect()
    assert [r.cluster for r in got] == want and not passes
    got = SP.ward_linkage(frame(spark, m), "k", "v", 6, few=400, block=50).orderBy("k").collect()
    assert [r.cluster for r in got] == want and set(passes) == {1}


def test_no_rows(spark):
    empty = frame(spark, np.zeros((1, 2))).where("k < 0")
    assert DB.dbscan(empty, "k", "v", 0.5, 2).count() == 0
    assert N.nearest_neighbors(empty, "k", "v", 2).count() == 0
    assert SP.single_linkage(empty, "k", "v", height=1.0).count() == 0
