"""Feature construction, scoring and selection."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions import stats as S
from wideloom.functions.moments import class_moments, moments_long
from wideloom.functions.vectors import matrix_column
from wideloom.operators.prep import _stats
from wideloom.operators.reduce import Gram, Projection, gram, pca_from_gram, poly_terms
from wideloom.operators.rowsums import sum_rows


def take(vec: str, index: Sequence[int]) -> Column:
    """A vector of the chosen entries."""
    return F.array(*[F.col(vec)[int(i)] for i in index])


def concat_blocks(*vecs: str) -> Column:
    """Feature blocks of the same row side by side."""
    return F.concat(*[F.col(v) for v in vecs])


# ---- unsupervised scores --------------------------------------------------------------

def variances(df: DataFrame, vec: str) -> DataFrame:
    return moments_long(df, vec).select("i", F.col("var").alias("variance"))


def variance_threshold(df: DataFrame, vec: str, threshold: float = 0.01) -> list[int]:
    """Indices whose population variance exceeds the threshold."""
    kept = [r["i"] for r in variances(df, vec).where(F.col("variance") > threshold).orderBy("i").collect()]
    if not kept:
        raise ValueError("no feature meets the variance threshold")
    return kept


# ---- supervised scores ------------------------------------------------------------------

def f_tail(f: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """P(F(d1, d2) > f) from the incomplete beta function (Lentz continued fraction)."""
    out = np.empty(len(f))
    for i, (fi, a0, b0) in enumerate(zip(f, d1, d2)):
        if not np.isfinite(fi):
            out[i] = 0.0 if fi == np.inf else np.nan
            continue
        x, a, b = b0 / (b0 + a0 * fi), b0 / 2, a0 / 2
        if x <= 0 or x >= 1:
            out[i] = float(x >= 1)
            continue
        swap = x > (a + 1) / (a + b + 2)
        if swap:
            a, b, x = b, a, 1 - x
        front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
        c, d = 1.0, 1.0 / max(1 - (a + b) * x / (a + 1), 1e-300)
        h = d
        for m in range(1, 500):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                        -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 / (1 + num * d)
                c = 1 + num / c
                h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        out[i] = 1 - front * h if swap else front * h
    return out


def _f_tail_column(*cols) -> Column:
    @arrow_udf("double")
    def run(f: pa.Array, d1: pa.Array, d2: pa.Array) -> pa.Array:
        return pa.array(f_tail(*[c.to_numpy(zero_copy_only=False).astype(float) for c in (f, d1, d2)]))

    return run(*cols)


def anova_f(df: DataFrame, vec: str, label: str, p_values: bool = False) -> DataFrame:
    """(i, f): one-way ANOVA per feature from class counts, means and variances."""
    per = moments_long(df, vec, [label]).select(
        "i", F.col("n").cast("double").alias("n"), F.col("mean").alias("m"), F.col("var").alias("v"))
    tot = per.groupBy("i").agg(
        F.sum("n").alias("n"), F.count("*").cast("double").alias("k"),
        F.sum(F.col("n") * F.col("m")).alias("s"), F.sum(F.col("n") * F.col("v")).alias("within"))
    j = per.select("i", F.col("n").alias("nc"), F.col("m").alias("mc")).join(tot, "i")
    d = F.col("mc") - F.col("s") / F.col("n")
    b = j.groupBy("i", "n", "k", "within").agg(F.sum(F.col("nc") * d * d).alias("between"))
    out = b.withColumn("f", S.ratio(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k"))))
    if p_values:
        out = out.withColumn("p_value", _f_tail_column("f", F.col("k") - 1, F.col("n") - F.col("k")))
    return out.select("i", "f", *(["p_value"] if p_values else []))


def chi2(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Chi-squared of class-wise feature sums against the class shares; the whole table is
    shifted to be non-negative first."""
    per = moments_long(df, vec, [label])
    low = per.agg(F.least(F.min("min"), F.lit(0.0))).scalar()
    obs = per.select("i", F.col("n").cast("double").alias("n"), (F.col("n") * (F.col("mean") - low)).alias("obs"))
    tot = obs.groupBy("i").agg(F.sum("obs").alias("total"), F.sum("n").alias("rows"))
    e = F.col("n") / F.col("rows") * F.col("total")
    return obs.join(tot, "i").groupBy("i").agg(
        F.sum((F.col("obs") - e) * (F.col("obs") - e) / F.nullif(e, F.lit(0.0))).alias("chi2"))


MAX_CLASSES = 10_000


def class_codes(df: DataFrame, label: str) -> tuple[list, Column]:
    """Sorted classes and the 0-based class number as a column expression."""
    classes = sorted(r[0] for r in df.select(label).where(F.col(label).isNotNull()).distinct().limit(MAX_CLASSES + 1).collect())
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label!r}: not a class label")
    return classes, F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1


def binned_mutual_information(df: DataFrame, vec: str, label: str, bins: int = 10) -> DataFrame:
    """(i, mi): mutual information in nats of each feature, cut into equal-width bins, with
    the label.  One pass sums the (feature, bin, class) counts."""
    ends = class_moments(df, vec).first()
    lo, hi = np.array(ends["min"]), np.array(ends["max"])
    w = np.where(hi > lo, (hi - lo) / bins, 1.0)
    classes, code = class_codes(df, label)
    p, k = len(lo), len(classes)

    def part(x, y):
        b = np.minimum(np.floor((x - lo) / w), bins - 1).astype(np.int64)
        flat = (np.arange(p)[None, :] * bins + b) * k + y.astype(np.int64)[:, None]
        return [np.bincount(flat.ravel(), minlength=p * bins * k).reshape(p, bins, k)]

    n = sum_rows(df.where(F.col(label).isNotNull()).select(F.col(vec).alias("v"), code.alias("y")), ["v", "y"], part,
                 numbers=p * bins * k)[0]
    total = n.sum(axis=(1, 2), keepdims=True)
    expected = n.sum(axis=2, keepdims=True) * n.sum(axis=1, keepdims=True)
    mi = np.where(n > 0, n / total * np.log(np.where(n > 0, n * total, 1) / np.where(n > 0, expected, 1)), 0).sum(axis=(1, 2))
    return df.sparkSession.createDataFrame([(i, float(m)) for i, m in enumerate(mi)], "i int, mi double")


def k_best(scores: DataFrame, score: str, k: int, index: str = "i") -> list[int]:
    """Indices of the k highest scores, in feature order (lower index first on ties)."""
    top = scores.orderBy(F.desc_nulls_last(score), index).limit(k).select(index).collect()
    return sorted(r[0] for r in top)


def best_percentile(scores: DataFrame, score: str, percentile: float, index: str = "i") -> list[int]:
    """Features strictly above the (100 - percentile) score quantile, then ties in feature
    order up to the allowed count."""
    rows = scores.select(index, score).orderBy(index).collect()
    s = np.array([-np.inf if r[1] is None else r[1] for r in rows], float)
    if percentile >= 100:
        return [r[0] for r in rows]
    cut = np.percentile(s, 100 - percentile)
    allowed = int(len(s) * percentile / 100)
    keep = s > cut
    for t in np.flatnonzero(s == cut)[:max(0, allowed - int(keep.sum()))]:
        keep[t] = True
    return [rows[i][0] for i in np.flatnonzero(keep)]


def forest_importance(df: DataFrame, vec: str, label: str, trees: int = 100, seed: int = 42, depth: int = 10
                      ) -> np.ndarray:
    """Impurity importances of a random forest; labels are 0..k-1."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    data = df.select(array_to_vector(F.col(vec)).alias("features"), F.col(label).cast("double").alias("label"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt")
    return np.array(forest.fit(data).featureImportances.toArray())


def select_from_model(importance: np.ndarray, threshold: float | str | None = "mean", max_features: int | None = None
                      ) -> list[int]:
    cut = -np.inf if threshold is None else float(importance.mean()) if threshold == "mean" else \
        float(np.median(importance)) if threshold == "median" else float(threshold)
    order = sorted(range(len(importance)), key=lambda i: (-importance[i], i))
    if max_features is not None:
        order = order[:max_features]
    return sorted(i for i in order if importance[i] >= cut)


def importance_table(df: DataFrame, vec: str, label: str, top_n: int = 20, trees: int = 100) -> DataFrame:
    imp = forest_importance(df, vec, label, trees)
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))[:top_n]
    return df.sparkSession.createDataFrame(
        [(r + 1, i, float(imp[i])) for r, i in enumerate(order)], "position int, feature int, importance double")


def pair_products(df: DataFrame, vec: str, label: str, index: Sequence[int], top: int = 10, p_values: bool = False
                  ) -> DataFrame:
    """F statistic of the product of every pair of the given features; the best pairs."""
    index = [int(i) for i in index]
    a = np.array([x for n, x in enumerate(index) for _ in index[n + 1:]])
    b = np.array([y for n, _ in enumerate(index) for y in index[n + 1:]])
    products = df.select(label, matrix_column(lambda x: x[:, a] * x[:, b], vec).alias("products"))
    name = [F.array(*[F.lit(int(v)) for v in side])[F.col("i")] for side in (a, b)]
    scores = anova_f(products, "products", label, p_values).select(name[0].alias("a"), name[1].alias("b"), "*").drop("i")
    return scores.orderBy(F.desc("f"), "a", "b").limit(top)


def discriminative_pairs(df: DataFrame, vec: str, label: str, base: int = 20, top: int = 10, trees: int = 100
                         ) -> DataFrame:
    """Products of the ``base`` most important features that best separate the classes."""
    imp = forest_importance(df, vec, label, trees)
    order = sorted(range(len(imp)), key=lambda i: (-imp[i], i))[:base]
    return pair_products(df, vec, label, order, top, p_values=True)


# ---- construction -------------------------------------------------------------------------

def polynomial_columns(cols: Sequence[str], degree: int = 2, interaction_only: bool = False, bias: bool = False
                       ) -> dict[str, Column]:
    """Products up to the degree as generated expressions, graded order, named ``a*b``."""
    out: dict[str, Column] = {"1": F.lit(1.0)} if bias else {}
    for term in poly_terms(len(cols), degree, interaction_only):
        e = F.col(cols[term[0]]).cast("double")
        for t in term[1:]:
            e = e * F.col(cols[t]).cast("double")
        out["*".join(cols[t] for t in term)] = e
    return out


def matching_pairs(names: Sequence[str], left: str = "_L_", right: str = "_R_") -> list[tuple[str, str]]:
    """Columns that differ only in the left/right marker."""
    known = set(names)
    return [(n, n.replace(left, right)) for n in names if left in n and n.replace(left, right) in known]


def pair_ratios(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Appends ``ratio_<left>``; a zero or missing denominator becomes the column mean."""
    mean = _stats(df, [r for _, r in pairs], m=F.avg)
    return df.withColumns({
        f"ratio_{a}": F.col(a).cast("double") / F.nullif(
            F.coalesce(F.nullif(S.clean(F.col(b)), F.lit(0.0)), F.lit(mean[b]["m"])), F.lit(0.0)) for a, b in pairs})


def pair_ratio_vector(df: DataFrame, vec: str, pairs: Sequence[tuple[int, int]], out: str) -> DataFrame:
    """The same on vector entries: the vector with one ratio per pair appended."""
    row = df.agg(*[F.avg(F.col(vec)[int(b)]).alias(f"m{i}") for i, (_, b) in enumerate(pairs)]).first()
    extra = [F.col(vec)[int(a)] / F.nullif(F.coalesce(F.nullif(F.col(vec)[int(b)], F.lit(0.0)), F.lit(row[f"m{i}"])),
                                           F.lit(0.0)) for i, (a, b) in enumerate(pairs)]
    return df.withColumn(out, F.concat(F.col(vec), F.array(*extra)))


def variable_ratio_pairs(variance: np.ndarray, base: int = 10, last: int = 15) -> list[tuple[int, int]]:
    """Each of the ``base`` most variable features over the ones after it, up to position
    ``last``."""
    top = sorted(range(len(variance)), key=lambda i: (-variance[i], i))
    return [(a, b) for i, a in enumerate(top[:base]) for b in top[i + 1:last]]


def variable_ratios(df: DataFrame, cols: Sequence[str], base: int = 10, last: int = 15) -> DataFrame:
    st = _stats(df, cols, v=F.var_pop)
    pairs = variable_ratio_pairs(np.array([st[c]["v"] for c in cols]), base, last)
    return df.withColumns({f"ratio_{cols[a]}_{cols[b]}": S.ratio(F.col(cols[a]).cast("double"),
                                                                 F.col(cols[b]).cast("double") + F.lit(1e-10))
                           for a, b in pairs})


# Substrings that mark an important feature.
IMPORTANT_WORDS = (
    "cortex", "cerebellum", "thalamus", "amygdala", "hippocampus", "striatum", "caudate", "putamen",
    "pallidum", "accumbens", "corpus", "callosum", "frontal")


def keyword_weights(names: Sequence[str], words: Sequence[str] = IMPORTANT_WORDS, boost: float = 1.5) -> np.ndarray:
    """1.5 for names holding an important word, else 1; scaled to mean one."""
    w = np.array([boost if any(k in n.lower() for k in words) else 1.0 for n in names])
    return w / w.mean()


# ---- correlation graph ----------------------------------------------------------------------

def correlation_edges(g: Gram, threshold: float = 0.5) -> list[tuple[int, int, float]]:
    c = np.abs(g.corr)
    return [(i, j, float(c[i, j])) for i in range(len(c)) for j in range(i + 1, len(c)) if c[i, j] > threshold]


def eigenvector_centrality(p: int, edges: Sequence[tuple[int, int, float]], max_iter: int = 1000, tol: float = 1e-6
                           ) -> np.ndarray:
    """Power iteration on the (p x p) graph, shifted by the identity."""
    a = np.eye(p)
    for i, j, w in edges:
        a[i, j] += w
        a[j, i] += w
    x = np.full(p, 1.0 / p)
    for _ in range(max_iter):
        y = a @ x
        y /= np.linalg.norm(y) or 1.0
        if np.abs(y - x).sum() < p * tol:
            return y
        x = y
    raise RuntimeError(f"centrality did not converge in {max_iter} rounds")


def graph_selection(df: DataFrame, vec: str, threshold: float = 0.5, limit: int = 100, on: str = "standard") -> tuple[
        list[int], np.ndarray, Gram]:
    """Most central features of the correlation graph.

    ``on="whitened"`` builds the graph on whitened components, whose correlations vanish,
    so every component ties; the default uses the input's own correlations.
    """
    return _graph_order(gram(df, vec), threshold, limit, on)


def _graph_order(g: Gram, threshold: float, limit: int, on: str) -> tuple[list[int], np.ndarray, Gram]:
    if on == "whitened":
        w = pca_from_gram(g, None, True)
        g = Gram(g.n, np.zeros(w.matrix.shape[1]), w.matrix.T @ g.scatter @ w.matrix)
    elif on != "standard":
        raise ValueError("on is 'standard' or 'whitened'")
    c = eigenvector_centrality(len(g.mean), correlation_edges(g, threshold))
    order = sorted(range(len(c)), key=lambda i: (-round(float(c[i]), 12), i))[:min(len(c), limit)]
    return order, c, g


def graph_selection_pca(df: DataFrame, vec: str, k: int, threshold: float = 0.5, limit: int = 100,
                        on: str = "standard") -> Projection:
    """Select central features, then PCA: one projection, since selection is a matrix."""
    full = gram(df, vec)
    order, _, _ = _graph_order(full, threshold, limit, on)
    white = pca_from_gram(full, None, True)
    if on == "whitened":
        basis, mean = white.matrix[:, order], full.mean
    else:
        sd = np.sqrt(np.maximum(np.diag(full.cov), 0))
        basis = np.zeros((len(full.mean), len(order)))
        basis[order, np.arange(len(order))] = 1 / np.where(sd[order] > 0, sd[order], 1)
        mean = full.mean
    inner = Gram(full.n, np.zeros(len(order)), basis.T @ full.scatter @ basis)
    sub = pca_from_gram(inner, min(k, len(order)))
    return Projection(mean, basis @ sub.matrix, sub.explained, sub.ratio)
