"""Composed feature work: declarative step lists and the named approaches.

A step takes a frame with a vector column and returns the frame with that column replaced.
Fitting a step scans the rows; the transform it adds stays a lazy column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wideloom.functions.vectors import fit_batches, matrix_column, width
from wideloom.operators import features as FT
from wideloom.operators import manifold as MF
from wideloom.operators import reduce as R
from wideloom.operators.hierarchy import feature_agglomeration
from wideloom.operators.prep import robust_vector_stats
from wideloom.operators.rowsums import sum_rows
from wideloom.operators.trees import extra_trees


class VectorScale:
    def __init__(self, shift: np.ndarray, spread: np.ndarray):
        self.shift, self.spread = shift, np.where(spread == 0, 1.0, spread)

    def transform(self, df: DataFrame, vec: str, out: str) -> DataFrame:
        shift, spread = self.shift, self.spread
        return df.withColumn(out, matrix_column(lambda x: (x - shift) / spread, vec))


def scale_vector(df: DataFrame, vec: str, how: str = "standard") -> VectorScale:
    if how == "standard":
        g = R.gram_diagonal(df, vec)
        return VectorScale(g[0], np.sqrt(g[1]))
    if how == "robust":
        return VectorScale(*robust_vector_stats(df, vec, width(df, vec)))
    if how not in ("minmax", "maxabs"):
        raise ValueError(f"unknown scaling {how!r}")
    lo, hi = sum_rows(df, [vec], lambda x: (x.min(axis=0), x.max(axis=0)),
                      lambda a, b: (np.minimum(a[0], b[0]), np.maximum(a[1], b[1])), numbers=1000)
    if how == "minmax":
        return VectorScale(lo, hi - lo)
    return VectorScale(np.zeros_like(lo), np.maximum(np.abs(lo), np.abs(hi)))


def _select(df: DataFrame, vec: str, index: Sequence[int]) -> DataFrame:
    index = np.asarray(index)
    return df.withColumn(vec, matrix_column(lambda x: x[:, index], vec))


def _k(df, vec, p, default) -> int:
    return int(min(p.get("n_components", default), width(df, vec)))


def _need_label(label):
    if label is None:
        raise ValueError("this step needs a label column")
    return label


def _polynomial(df, key, vec, label, p, k):
    return _interactions(df, vec, p.get("degree", 2), False)


def _select_model(df, key, vec, label, p, k):
    """``importance`` may be any function of (frame, vector column, label column); extremely randomised trees if not given."""
    own = p.get("importance")
    imp = own(df, vec, _need_label(label)) if own else extra_trees(df, vec, _need_label(label), p.get("trees", 100)).importance
    return _select(df, vec, FT.select_from_model(imp, p.get("threshold", "mean"), p.get("max_features")))


def _embedded(df, key, vec, found):
    """The frame with each row's embedding as its vector."""
    found = found.select(F.col(key).alias("_row"), F.col("embedding").alias("_place"))
    return df.join(found, F.col(key) == F.col("_row")).withColumn(vec, F.col("_place")).drop("_row", "_place")


STEPS: dict[str, Callable] = {
    "scaling": lambda df, key, vec, label, p, k: scale_vector(df, vec, p.get("type", "standard")).transform(df, vec, vec),
    "polynomial": _polynomial,
    "select_variance": lambda df, key, vec, label, p, k: _select(
        df, vec, FT.variance_threshold(df, vec, p.get("threshold", 0.01))),
    "kernel_pca": lambda df, key, vec, label, p, k: R.kernel_pca(
        df, key, vec, _k(df, vec, p, k), p.get("kernel", "rbf"), p.get("gamma")).transform(df, vec, vec),
    "nmf": lambda df, key, vec, label, p, k: R.nmf(df, vec, _k(df, vec, p, k)).transform(df, vec, vec),
    "ica": lambda df, key, vec, label, p, k: R.ica(df, vec, _k(df, vec, p, k)).transform(df, vec, vec),
    "random_projection": lambda df, key, vec, label, p, k: R.random_projection(
        df, vec, _k(df, vec, p, k)).transform(df, vec, vec),
    "polynomial_pca": lambda df, key, vec, label, p, k: (R.sketched_polynomial_pca if p.get("sketch") else R.polynomial_pca)(
        df, vec, _k(df, vec, p, k), p.get("degree", 2)).transform(df, vec, vec),
    "feature_agglomeration": lambda df, key, vec, label, p, k: feature_agglomeration(
        df, vec, int(min(p.get("n_clusters", k), width(df, vec))), p.get("linkage", "ward")).transform(df, vec, vec),
    "select_from_model": _select_model,
    "dictionary_learning": lambda df, key, vec, label, p, k: R.dictionary_learning(
        df, vec, _k(df, vec, p, k), p.get("alpha", 1.0)).transform(df, vec, vec),
    "isomap": lambda df, key, vec, label, p, k: _embedded(df, key, vec, MF.isomap(
        df, key, vec, _k(df, vec, p, k), p.get("n_neighbors", 5))),
    "lle": lambda df, key, vec, label, p, k: _embedded(df, key, vec, MF.locally_linear_embedding(
        df, key, vec, _k(df, vec, p, k), p.get("n_neighbors", 5))),
    "spectral": lambda df, key, vec, label, p, k: _embedded(df, key, vec, MF.spectral_embedding(
        df, key, vec, _k(df, vec, p, k), p.get("n_neighbors", 15) - 1)[1]),
    "truncated_svd": lambda df, key, vec, label, p, k: R.truncated_svd(
        df, vec, _k(df, vec, p, k)).transform(df, vec, vec),
    "select_percentile": lambda df, key, vec, label, p, k: _select(df, vec, FT.best_percentile(
        FT.chi2(df, vec, _need_label(label)), "chi2", p.get("percentile", 10))),
}


def run_steps(df: DataFrame, key: str, vec: str, steps: Sequence[dict] | None = None, label: str | None = None,
              components: int = 20) -> DataFrame:
    """Apply a list of ``{"name": ..., **parameters}``; unknown names raise.  The default
    is standard scaling followed by RBF kernel PCA."""
    if steps is None:
        steps = [{"name": "scaling", "type": "standard"},
                 {"name": "kernel_pca", "n_components": components, "kernel": "rbf"}]
    for s in steps:
        if s.get("name") not in STEPS:
            raise ValueError(f"unknown step {s.get('name')!r}")
    for s in steps:
        df = STEPS[s["name"]](df, key, vec, label, {k: v for k, v in s.items() if k != "name"}, components)
    return df


# ---- composed reductions --------------------------------------------------------------------

def side_by_side(df: DataFrame, vec: str, models: Sequence, out: str) -> DataFrame:
    """Outputs of several fitted models on the same rows, concatenated."""
    parts = []
    for i, m in enumerate(models):
        df = m.transform(df, vec, f"_part{i}")
        parts.append(f"_part{i}")
    return df.withColumn(out, FT.concat_blocks(*parts)).drop(*parts)


def ensemble_reduction(df: DataFrame, key: str, vec: str, k: int = 20, ica_rounds: int = 200) -> DataFrame:
    """Whitened PCA, kernel PCA and ICA side by side, then whitened PCA."""
    both = side_by_side(df, vec, [R.pca(df, vec, k, True), R.kernel_pca(df, key, vec, k),
                                  R.ica(df, vec, k, ica_rounds)], vec)
    return R.pca(both, vec, k, True).transform(both, vec, vec)


def _robust_variance(df, vec):
    df = scale_vector(df, vec, "robust").transform(df, vec, vec)
    return _select(df, vec, FT.variance_threshold(df, vec, 0.01))


def _interactions(df, vec, degree: int = 2, interaction_only: bool = True):
    p = width(df, vec)
    fit_batches(df, len(R.poly_terms(p, degree, interaction_only)))
    return df.withColumn(vec, matrix_column(R.poly_expand(p, degree, interaction_only), vec))


def auto_features(df: DataFrame, key: str, vec: str, k: int = 20, interactions: bool = True) -> DataFrame:
    """Robust scaling, variance cut, interactions under 100 features, agglomeration when
    still wider than 3k, whitened PCA."""
    df = _robust_variance(df, vec)
    if interactions and width(df, vec) < 100:
        df = _interactions(df, vec)
    p = width(df, vec)
    if p > 3 * k:
        df = feature_agglomeration(df, vec, min(2 * k, p // 2)).transform(df, vec, vec)
    return R.pca(df, vec, k, True).transform(df, vec, vec)


def clustering_features(df: DataFrame, key: str, vec: str, k: int = 20, labelled: bool = False) -> DataFrame:
    """Robust scaling, variance cut, agglomeration above 100 features, RBF kernel PCA with
    gamma 10 / p, and truncated SVD when labels are known."""
    df = _robust_variance(df, vec)
    p = width(df, vec)
    if p > 100:
        df = feature_agglomeration(df, vec, min(100, p // 2)).transform(df, vec, vec)
        p = width(df, vec)
    df = R.kernel_pca(df, key, vec, k, "rbf", 10.0 / p).transform(df, vec, vec)
    return R.truncated_svd(df, vec, min(k, width(df, vec))).transform(df, vec, vec) if labelled else df


def combined_features(df: DataFrame, key: str, vec: str, k: int = 20, pairs: Sequence[tuple[int, int]] = ()) -> DataFrame:
    """Paired ratios, robust scaling, variance cut, interactions under 100 features,
    agglomeration above 1000, then whitened PCA, RBF and polynomial kernel PCA at 2k side
    by side and a final whitened PCA."""
    if pairs:
        df = FT.pair_ratio_vector(df, vec, pairs, vec)
    df = _robust_variance(df, vec)
    if width(df, vec) < 100:
        df = _interactions(df, vec)
    p = width(df, vec)
    if p > 1000:
        df = feature_agglomeration(df, vec, min(1000, p // 2)).transform(df, vec, vec)
        p = width(df, vec)
    m = min(2 * k, p)
    both = side_by_side(df, vec, [R.pca(df, vec, m, True), R.kernel_pca(df, key, vec, m, "rbf", 10.0 / p),
                                  R.kernel_pca(df, key, vec, m, "poly", 1.0 / p)], vec)
    return R.pca(both, vec, k, True).transform(both, vec, vec)


def variance_interactions(df: DataFrame, key: str, vec: str, label: str, k: int = 20, threshold: float = 0.1,
                          max_inputs: int = 50, max_features: int = 1000) -> DataFrame:
    """Variance cut, the 50 features most informative about the label, their interactions,
    again the most informative 1000, whitened PCA."""
    df = _select(df, vec, FT.variance_threshold(df, vec, threshold))
    if width(df, vec) > max_inputs:
        df = _select(df, vec, FT.k_best(FT.binned_mutual_information(df, vec, label), "mi", max_inputs))
    df = _interactions(df, vec)
    if width(df, vec) > max_features:
        df = _select(df, vec, FT.k_best(FT.binned_mutual_information(df, vec, label), "mi", max_features))
    return R.pca(df, vec, k, True).transform(df, vec, vec)


def _whiten(method, **params):
    return lambda df, key, vec, label, k: R.whiten(df, vec, method, k, **params).transform(df, vec, vec)


def _steps(*steps):
    return lambda df, key, vec, label, k: run_steps(
        df, key, vec, [{**s, **({"n_components": k} if s["name"] == "kernel_pca" else {}),
                        **({"n_clusters": k} if s.get("n_clusters") == "k" else {})} for s in steps], label, k)


def _interaction_pca(df, key, vec, label, k):
    df = _interactions(df, vec)
    return R.pca(df, vec, k, True).transform(df, vec, vec)


def _ratio_pca(df, key, vec, label, k, pairs=None):
    p = width(df, vec)
    df = FT.pair_ratio_vector(df, vec, pairs or [(i, i + p // 2) for i in range(p // 2)], vec)
    df = scale_vector(df, vec, "robust").transform(df, vec, vec)
    return R.pca(df, vec, k, True).transform(df, vec, vec)


# name -> (frame, key, vector column, label column, components) -> frame
APPROACHES: dict[str, Callable] = {
    "standard_pca": lambda df, key, vec, label, k: R.pca(df, vec, k).transform(df, vec, vec),
    "variance_selection": _steps({"name": "select_variance", "threshold": 0.01}),
    "kernel_pca": _steps({"name": "kernel_pca", "kernel": "rbf"}),
    "feature_agglomeration": _steps({"name": "feature_agglomeration", "n_clusters": "k"}),
    "select_percentile": _steps({"name": "select_percentile", "percentile": 30}),
    "selection_kernel_pca": _steps({"name": "select_variance", "threshold": 0.01}, {"name": "kernel_pca"}),
    "agglomeration_kernel_pca": _steps({"name": "feature_agglomeration", "n_clusters": 50}, {"name": "kernel_pca"}),
    "whitened_pca": lambda df, key, vec, label, k: R.pca(df, vec, k, True).transform(df, vec, vec),
    "optimal_kernel_pca": _steps({"name": "kernel_pca", "kernel": "rbf", "gamma": 0.1}),
    "interactions_pca": _interaction_pca,
    "ratios_pca": _ratio_pca,
    "ensemble_reduction": lambda df, key, vec, label, k: ensemble_reduction(df, key, vec, k),
    "variance_interactions": lambda df, key, vec, label, k: variance_interactions(df, key, vec, label, k),
    "clustering_features": lambda df, key, vec, label, k: clustering_features(df, key, vec, k, label is not None),
    "combined_features": lambda df, key, vec, label, k: combined_features(
        df, key, vec, k, [(i, i + width(df, vec) // 2) for i in range(width(df, vec) // 2)]),
    "zca_pca": _whiten("zca"),
    "graph_selection_pca": lambda df, key, vec, label, k: FT.graph_selection_pca(df, vec, k).transform(df, vec, vec),
    "cholesky": _whiten("cholesky"),
    "mahalanobis": _whiten("mahalanobis"),
    "adaptive": _whiten("adaptive", alpha=1.0),
    "hybrid": _whiten("hybrid", zca_weight=0.5),
    "double_pca": lambda df, key, vec, label, k: R.double_pca(df, vec, k).transform(df, vec, vec),
}


def two_component_view(df: DataFrame, key: str, vec: str, label: str, models: dict[str, object]) -> DataFrame:
    """First two components of each model with the class, as (method, key, label, c1, c2)."""
    out = None
    for name, m in models.items():
        part = m.transform(df, vec, "_z").select(
            F.lit(name).alias("method"), F.col(key).alias("key"), F.col(label).alias("label"),
            F.col("_z")[0].alias("c1"), F.col("_z")[1].alias("c2"))
        out = part if out is None else out.unionByName(part)
    return out
