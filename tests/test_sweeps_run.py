"""Sweeps run in full on small tables whose rows have little variance, as raw embeddings have."""

import numpy as np
import pyarrow as pa
import pytest

from wideloom.operators import affinity as AP
from wideloom.plans import sweeps as SW


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(5)
    y = np.arange(48) % 2
    x = (rng.normal(size=(48, 6)) + 4 * y[:, None]) * 0.01
    return spark.createDataFrame(pa.table({"k": pa.array(np.arange(48)), "label": pa.array(y), "v": pa.array(list(x))})).repartition(2).persist()


def test_approaches_on_standardised_rows(small):
    names = ("standard_pca", "variance_interactions", "ratios_pca")
    got = {r.approach: r for r in SW.approach_comparison(small, "k", "v", "label", names, 2, 2).collect()}
    assert set(got) == set(names) and all(0 <= r.accuracy <= 1 and r.best_method in ("kmeans", "gmm") for r in got.values())
    assert got["standard_pca"].accuracy == 1.0


def test_every_pair_of_reduction_and_clustering(small):
    pairs = SW.reduction_by_clustering(small, "k", "v", "label", 2, 2, ("standard_pca", "truncated_svd"), ("kmeans", "agglomerative_ward"))
    rows = {(r.reduction, r.clustering): r for r in pairs.collect()}
    assert len(rows) == 4 and all(r.n_clusters == 2 for r in rows.values())
    assert rows["standard_pca", "kmeans"].accuracy == 1.0


def test_affinity_says_whether_it_settled(small):
    done = AP.affinity_propagation(small, "k", "v", 0.9, 80, 8, neighbors=6).collect()
    assert len(done) == 48 and len({r.converged for r in done}) == 1
    with pytest.warns(UserWarning):
        cut = AP.affinity_propagation(small, "k", "v", 0.9, 3, 8, neighbors=6).collect()
    assert not cut[0].converged
