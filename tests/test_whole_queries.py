"""Queries over all features and all methods."""

import numpy as np

from conftest import SF
from wideloom.plans.catalog import QUERIES


def test_pairs_reach_all_features(spark, x):
    got = QUERIES["top_corr_pairs_all"](spark, SF).collect()
    c = np.abs(np.triu(np.corrcoef(x.T), 1))
    assert np.allclose([abs(r.value) for r in got], np.sort(c.ravel())[::-1][:10], atol=1e-6)
    assert max(int(r.b[1:]) for r in got) >= 20


def test_every_whitening_is_returned(spark, x):
    got = {}
    for r in QUERIES["whitening_comparison_all"](spark, SF).collect():
        got.setdefault(r.method, np.full((2, 2), np.nan))[r.i, r.j] = r["cov"]
    assert len(got) == 11 and not any(np.isnan(m).any() for m in got.values())
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:2]
    assert np.allclose(got["pca"], np.diag(values), atol=2e-3)
    for name in ("pca_whiten", "zca", "cholesky", "mahalanobis", "adaptive_1.0"):
        assert np.allclose(got[name], np.eye(2), atol=2e-3)
