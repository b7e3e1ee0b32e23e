"""Method and parameter sweeps, returned as ordinary result tables.

A sweep fits all its clusterings in shared passes, labels the rows once with every model
and scores all runs from one contingency table.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.joins import join_groups
from wideloom.functions.vectors import from_matrix, to_matrix, width
from wideloom.operators import evaluate as E
from wideloom.operators import features as FT
from wideloom.operators import reduce as R
from wideloom.operators.affinity import affinity_propagation
from wideloom.operators.dbscan import VECTORS, dbscan, dbscan_grid, eps_from_neighbors
from wideloom.operators.gmm import GaussianMixture, best_component_count, fit_many_gmm, top_two_binary
from wideloom.operators.hierarchy import agglomerative, ensemble
from wideloom.operators.kmeans import KMeansModel, Spec, fit_many, kmeans
from wideloom.operators.meanshift import mean_shift
from wideloom.operators.prep import handle_outliers, scale
from wideloom.operators.rowsums import KeptRows, sum_rows
from wideloom.plans.steps import APPROACHES, combined_features, scale_vector, side_by_side
from wideloom.session import cut_lineage


def label_runs(df: DataFrame, vec: str, models: dict[str, KMeansModel | GaussianMixture], keep: Sequence[str]
               ) -> DataFrame:
    """(keep..., run, cluster): all models label each Arrow batch in one call."""
    fitted = [(m.factors() if isinstance(m, GaussianMixture) else None, m) for m in models.values()]

    @arrow_udf("array<double>")
    def run_all(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(pa.float64()))
        m = to_matrix(x)
        return from_matrix(np.stack([
            (k.log_joint(m, f).argmax(axis=1) if f else k.distances(m).argmin(axis=1)).astype(float)
            for f, k in fitted], axis=1))

    names = F.array(*[F.lit(n) for n in models])
    return df.select(*keep, F.posexplode(run_all(vec)).alias("_i", "_c")).select(
        *keep, F.element_at(names, F.col("_i") + 1).alias("run"), F.col("_c").cast("int").alias("cluster"))


def score_models(df: DataFrame, vec: str, label: str, models: dict) -> DataFrame:
    return E.score(label_runs(df, vec, models, [label]), label, "cluster", ["run"])


def component_sweep(df: DataFrame, key: str, vec: str, label: str, k: int, counts: Sequence[int],
                    method: str = "whitened_pca", n_init: int = 3, max_iter: int = 300, threshold: float = 0.5
                    ) -> DataFrame:
    """Scores of k-means on the first 1..c components (``threshold`` is that of the graph method).

    The components of every method here are nested, so one fit at the largest count serves
    every prefix, and all prefixes are clustered in the same passes.
    """
    if method in ("whitened_pca", "standard_pca", "double_pca"):
        model = R.pca(df, vec, max(counts), method == "whitened_pca")
    elif method in R.WHITENERS:
        model = R.whiten(df, vec, method, max(counts))
    elif method == "graph":
        model = FT.graph_selection_pca(df, vec, max(counts), threshold)
        counts = [c for c in counts if c <= model.matrix.shape[1]]
    else:
        raise ValueError(f"unknown sweep method {method!r}")
    z = model.transform(df, vec, "_z").select(key, label, "_z").persist()
    try:
        models = fit_many(z, key, "_z", {str(c): Spec(k, n_init, dims=c) for c in counts}, max_iter)
        return _landed(score_models(z, "_z", label, models).withColumn("n_components", F.col("run").cast("int")).drop("run"))
    finally:
        z.unpersist()


def _landed(result: DataFrame) -> DataFrame:
    """A result table (one row per run) as literal rows, free of the cached input."""
    return result.sparkSession.createDataFrame(result.collect(), result.schema)


def optimal_k(df: DataFrame, key: str, vec: str, max_k: int = 10, metric: str = "silhouette", n_init: int = 10,
              max_iter: int = 300) -> tuple[int, DataFrame]:
    """k in 2..max_k by best silhouette (squared or plain Euclidean) or by the elbow of the
    inertia."""
    data = df.select(key, F.col(vec).alias("v")).persist()
    try:
        models = fit_many(data, key, "v", {str(k): Spec(k, n_init) for k in range(2, max_k + 1)}, max_iter)
        if metric == "elbow":
            table = df.sparkSession.createDataFrame(
                [(int(k), float(m.inertia)) for k, m in models.items()], "k int, score double")
            return int(E.elbow(table, "k", "score").first()["k"]), table
        if metric == "silhouette_euclidean":
            table = df.sparkSession.createDataFrame([
                (int(k), float(E.silhouette_euclidean(m.transform(data, "v"), key, "v", "cluster").first()["silhouette"]))
                for k, m in models.items()], "k int, score double")
        elif metric == "silhouette":
            runs = label_runs(data, "v", models, ["v"])
            table = _landed(E.silhouette(runs, "v", "cluster", ["run"]).select(
                F.col("run").cast("int").alias("k"), F.col("silhouette").alias("score")))
        else:
            raise ValueError(f"unknown metric {metric!r}")
        return int(E.best_by(table, "score", "k").first()["k"]), table
    finally:
        data.unpersist()


def silhouettes(rows: KeptRows, vec: str, models: dict[str, KMeansModel]) -> dict[str, float | None]:
    """``E.silhouette`` of every model's labels on the entries it uses, in two passes for all models; none
    where one cluster holds all rows."""
    order = list(models.values())
    n, s = sum_rows(rows, [vec], lambda x: (np.array([float(len(x))]), x.sum(axis=0)), numbers=1000)
    shift = s / n[0]  # about the mean row a common offset does not cancel

    def clusters(x):
        out = []
        for m in order:
            v, at = m.entries(x) - m.entries(shift[None]), m.distances(x).argmin(axis=1)
            hot = np.zeros((len(x), len(m.centers)))
            hot[np.arange(len(x)), at] = 1.0
            out += [hot.sum(axis=0), hot.T @ v, hot.T @ (v * v).sum(axis=1)]
        return out

    flat = sum_rows(rows, [vec], clusters, numbers=sum(m.centers.size + 2 * len(m.centers) for m in order))
    stats = [flat[3 * i:3 * i + 3] for i in range(len(order))]

    def score(x):
        out = np.zeros(len(order))
        for i, (m, (size, total, square)) in enumerate(zip(order, stats)):
            v, own, at = m.entries(x) - m.entries(shift[None]), m.distances(x).argmin(axis=1), np.arange(len(x))
            d = (v * v).sum(axis=1)[:, None] * size - 2 * (v @ total.T) + square
            a = d[at, own] / np.maximum(size[own] - 1, 1)
            other = np.where(size > 0, np.maximum(d / np.maximum(size, 1), 0), np.inf)
            other[at, own] = np.inf
            b = other.min(axis=1)
            top = np.maximum(a, b)
            ok = (size[own] > 1) & np.isfinite(b) & (top > 0)
            out[i] = np.where(ok, (np.where(np.isfinite(b), b, 0) - a) / np.where(ok, top, 1), 0.0).sum()
        return [out]

    total = sum_rows(rows, [vec], score, numbers=len(order))[0]
    return {name: float(t / n[0]) if (st[0] > 0).sum() > 1 else None for name, t, st in zip(models, total, stats)}


def reduction_grid(df: DataFrame, key: str, vec: str, k: int, methods: Sequence[str] = R.REDUCTIONS,
                   counts: Sequence[int] = (2, 5, 10, 15, 20, 30, 40), n_init: int = 10, max_iter: int = 300
                   ) -> DataFrame:
    """Silhouette of k-means for every reduction method and component count.

    The outputs of all methods lie side by side in one vector, and all k-means share their passes.
    """
    counts = [c for c in counts if c <= width(df, vec)]
    fits, places = [], {}  # models, and (method, count) -> the model that serves it
    for method in methods:
        if method == "ica":  # sources of different counts are not nested
            many = R.reduce_by(df, key, vec, method, counts)
            places.update({(method, c): len(fits) + i for i, c in enumerate(counts)})
            fits += [many[c] for c in counts]
        else:
            places.update({(method, c): len(fits) for c in counts})
            fits.append(R.reduce_by(df, key, vec, method, max(counts)))
    starts = np.cumsum([0] + [m.matrix.shape[1] for m in fits])
    z = side_by_side(df, vec, fits, "_z").select(key, "_z").persist()
    rows = None
    try:
        specs = {f"{m} {c}": Spec(k, n_init, dims=min(c, fits[i].matrix.shape[1]), start=int(starts[i]))
                 for (m, c), i in places.items()}
        models = fit_many(z, key, "_z", specs, max_iter)
        rows = KeptRows(z, ["_z"])
        found = silhouettes(rows, "_z", models)
        return df.sparkSession.createDataFrame([(m, int(c), found[f"{m} {c}"]) for m, c in places],
                                               "method string, n_components int, silhouette double")
    finally:
        if rows is not None:
            rows.unpersist()
        z.unpersist()


def kmeans_variants(df: DataFrame, key: str, vec: str, label: str, k: int = 2, n_init: int = 10, enhanced_init: int = 15,
                    weights: Sequence[float] | None = None, max_iter: int = 300) -> tuple[DataFrame, dict]:
    """Standard k-means against the enhanced Euclidean, RBF and Manhattan variants."""
    specs = {"standard": Spec(k, n_init), **{
        f"enhanced_{m}": Spec(k, enhanced_init, metric=m, weights=weights, enhanced=True)
        for m in ("euclidean", "rbf", "manhattan")}}
    data = df.select(key, label, F.col(vec).alias("v")).persist()
    try:
        models = fit_many(data, key, "v", specs, max_iter)
        return _landed(score_models(data, "v", label, models)), models
    finally:
        data.unpersist()


def kmeans_against_gmm(df: DataFrame, key: str, vec: str, label: str, k: int = 2, n_init: int = 10,
                       covariances: Sequence[str] = ("full", "tied", "diag", "spherical"), max_iter: int = 100
                       ) -> DataFrame:
    """K-means and mixtures of every covariance type on the same rows, with rank by F1."""
    data = df.select(key, label, F.col(vec).alias("v")).persist()
    try:
        models: dict = {"kmeans": kmeans(data, key, "v", k, n_init)}
        models.update({f"gmm_{n}": m for n, m in fit_many_gmm(
            data, key, "v", {c: {"k": k, "covariance_type": c} for c in covariances}, max_iter).items()})
        return E.rank_results(_landed(score_models(data, "v", label, models)), "f1", ["run"])
    finally:
        data.unpersist()


def gmm_with_binary(df: DataFrame, key: str, vec: str, label: str, max_components: int = 10, n_runs: int = 3,
                    max_iter: int = 100) -> DataFrame:
    """The best mixture by BIC; with more than two components also its top-two binary
    labels.  One scored row per labelling."""
    data = df.select(key, label, F.col(vec).alias("v")).persist()
    try:
        n, _, fits = best_component_count(data, key, "v", max_components, "bic", n_runs, max_iter)
        best = fits[n]
        runs = best.transform(data, "v", "cluster").select(label, F.lit("gmm").alias("run"), "cluster")
        if n > 2:
            proba = data.withColumn("_p", best.predict_proba("v"))
            runs = runs.unionByName(top_two_binary(proba, "_p").select(label, F.lit("gmm_top2").alias("run"), "cluster"))
        return _landed(E.score(runs, label, "cluster", ["run"]).withColumn("components", F.lit(n)))
    finally:
        data.unpersist()


def dbscan_search(df: DataFrame, key: str, vec: str, label: str, eps: Sequence[float] | None = None,
                  min_samples: Sequence[int] | None = None) -> DataFrame:
    """ARI, NMI, cluster and noise counts and non-noise silhouette for every setting that
    yields at least two clusters."""
    data = df.select(key, label, F.col(vec).alias("v")).persist()
    try:
        n = data.count()
        eps = eps_from_neighbors(data, key, "v") if eps is None else list(eps)
        min_samples = sorted({5, 10, 15, 20, int(0.02 * n), int(0.05 * n)} - {0}) if min_samples is None else min_samples
        settings = [(float(e), int(m)) for e in eps for m in min_samples]
        runs = dbscan_grid(data, key, "v", settings).withColumnRenamed("key", key).join(data, key).persist()
        cells = E.contingency(runs, label, "cluster", ["run"])
        size = runs.groupBy("run").agg(
            F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).cast("int").alias("clusters"),
            F.count_if(F.col("cluster") == -1).alias("noise")).where("clusters >= 2")
        sil = E.silhouette(runs.where("cluster >= 0").join(F.broadcast(size.select("run")), "run"), "v", "cluster", ["run"])
        out = E.agreement(cells, ["run"]).join(size, "run").join(sil, "run")
        params = F.array(*[F.struct(F.lit(e).alias("eps"), F.lit(m).alias("min_samples")) for e, m in settings])
        result = _landed(out.withColumn("p", F.element_at(params, F.col("run") + 1)).select(
            "p.eps", "p.min_samples", "clusters", "noise", "ari", "nmi", "silhouette"))
        runs.unpersist()
        return result
    finally:
        data.unpersist()


ALGORITHMS = ("kmeans", "agglomerative_ward", "agglomerative_complete", "agglomerative_average", "dbscan", "mean_shift",
              "affinity")


def many_algorithms(df: DataFrame, key: str, vec: str, label: str, k: int = 2, eps: float = 0.5, min_samples: int = 5,
                    which: Sequence[str] = ALGORITHMS, neighbors: int = 20, max_iter: int = 50, max_micro: int = 512
                    ) -> tuple[DataFrame, DataFrame]:
    """Run several algorithms on the same rows: a wide frame of labels (one integer column
    per algorithm) and the scored table with cluster counts and seconds.

    No rows stand for others: linkages merge the rows, mean shift starts from every distinct one.
    ``max_micro`` only raises the number of clusters that are merged on the driver.
    """
    data = df.select(key, label, F.col(vec).alias("v")).persist()
    out, seconds = data, {}
    for name in which:
        start = time.perf_counter()
        if name == "kmeans":
            out = kmeans(data, key, "v", k).transform(out, "v", name)
        elif name.startswith("agglomerative_"):
            # Labels go by vector: rows whose keys repeat stay as many as they are.
            found = agglomerative(data, key, "v", k, name.split("_")[1], max_micro, name)
            found = cut_lineage(found.groupBy("v").agg(F.min(name).alias(name), F.count("*").alias("weight")))
            out = join_groups(out, found, "v", "weight", data.count(), VECTORS)
        elif name == "dbscan":
            out = out.join(dbscan(data, key, "v", eps, min_samples, name), key)
        elif name == "mean_shift":
            modes = mean_shift(data, key, "v", max_iter=max_iter, max_seeds=None)[0]
            out = out.join(modes.select(key, F.col("cluster").alias(name)), key)
        elif name == "affinity":
            ap = affinity_propagation(data, key, "v", 0.9, max_iter, neighbors=neighbors)
            ids = ap.select("exemplar").distinct()
            from wideloom.operators.ranks import cumulative

            numbers = cumulative(ids, [], "exemplar", {"one": F.count("*")}).select(
                "exemplar", F.col("before_one").cast("int").alias(name))
            out = out.join(ap.join(numbers, "exemplar").select(key, name), key)
        else:
            raise ValueError(f"unknown algorithm {name!r}")
        seconds[name] = time.perf_counter() - start
    out = cut_lineage(out)
    long = out.select(label, F.explode(F.array(*[
        F.struct(F.lit(n).alias("run"), F.col(n).cast("int").alias("cluster")) for n in which])).alias("r")).select(label, "r.*")
    counts = long.groupBy("run").agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).cast("int").alias("n_clusters"))
    took = df.sparkSession.createDataFrame([(n, float(s)) for n, s in seconds.items()], "run string, seconds double")
    table = _landed(E.score(long, label, "cluster", ["run"]).join(counts, "run").join(took, "run"))
    data.unpersist()
    return out, table


def ensemble_selection(df: DataFrame, key: str, vec: str, label: str, max_k: int = 5, weight_by: str = "ari", **options
                       ) -> tuple[DataFrame, DataFrame]:
    """Silhouette-optimal k, all algorithms, weighted consensus; returns consensus labels
    and the scored table including the consensus row."""
    k, _ = optimal_k(df, key, vec, max_k, n_init=options.pop("n_init", 3))
    classes = df.select(label).distinct().count()
    labels, table = many_algorithms(df, key, vec, label, k, **options)
    weights = {r["run"]: r[weight_by] for r in table.collect()}
    consensus = ensemble(labels, key, list(weights), weights, classes, out="consensus")
    row = _landed(E.score(consensus, label, "consensus")).select(
        F.lit("consensus").alias("run"), *E.METRICS, F.lit(classes).alias("n_clusters"), F.lit(None).cast("double").alias("seconds"))
    return consensus, table.unionByName(row)


def reduction_by_clustering(df: DataFrame, key: str, vec: str, label: str, components: int = 20, k: int | None = None,
                            reductions: Sequence[str] = ("standard_pca", "kernel_pca", "polynomial_pca", "truncated_svd"),
                            algorithms: Sequence[str] = ("kmeans", "agglomerative_ward", "dbscan", "mean_shift", "affinity"),
                            **options) -> DataFrame:
    """Every reduction with every clustering algorithm, one scored row per pair."""
    out = None
    for name in reductions:
        if name == "kernel_pca":
            model = R.kernel_pca(df, key, vec, components)
        elif name == "polynomial_pca":
            model = R.polynomial_pca(df, vec, components, 2)
        elif name == "truncated_svd":
            model = R.truncated_svd(df, vec, components)
        else:
            model = R.pca(df, vec, components)
        z = model.transform(df, vec, "_z").select(key, label, "_z")
        kk = optimal_k(z, key, "_z", 10)[0] if k is None else k
        _, table = many_algorithms(z, key, "_z", label, kk, which=algorithms, **options)
        part = table.select(F.lit(name).alias("reduction"), F.col("run").alias("clustering"), *E.METRICS, "n_clusters")
        out = part if out is None else out.unionByName(part)
    return out


def approach_comparison(df: DataFrame, key: str, vec: str, label: str, approaches: Sequence[str], components: int = 20,
                        k: int = 2, n_init: int = 3, max_iter: int = 300) -> DataFrame:
    """Named feature approaches on the standardised rows, each clustered by k-means and by a mixture;
    one row per approach with the better of the two by F1."""
    data = df.select(key, label, F.col(vec).alias("v"))
    data = scale_vector(data, "v", "standard").transform(data, "v", "v").persist()
    kept, z = [data], data
    try:
        for i, name in enumerate(approaches):  # every approach starts from its own copy of the rows' vector
            z = APPROACHES[name](z.withColumn(f"_z{i}", F.col("v")), key, f"_z{i}", label, components)
        parts = [f"_z{i}" for i in range(len(approaches))]
        z = z.select(key, label, *parts).persist()
        kept.append(z)
        sizes = z.where(F.least(*[F.size(c) for c in parts], F.lit(1)) > 0).select(*[F.size(c) for c in parts]).first()
        if sizes is None:
            raise ValueError("no rows with a vector of every approach")
        wide = dict(zip(approaches, sizes))
        starts = dict(zip(approaches, np.cumsum([0, *sizes]).tolist()))
        z = z.select(key, label, FT.concat_blocks(*parts).alias("_z"))
        models: dict = {f"{n} kmeans": m for n, m in fit_many(
            z, key, "_z", {n: Spec(k, n_init, dims=p, start=starts[n]) for n, p in wide.items()}, max_iter).items()}
        models |= {f"{n} gmm": m for n, m in fit_many_gmm(
            z, key, "_z", {n: {"k": k, "covariance_type": "diag", "dims": p, "start": starts[n]} for n, p in wide.items()},
            max_iter).items()}
        scored = _landed(score_models(z, "_z", label, models).withColumn("_run", F.split("run", " ")).select(
            F.col("_run")[0].alias("approach"), F.col("_run")[1].alias("best_method"), *E.METRICS))
        best = scored.groupBy("approach").agg(F.max_by(F.struct("best_method", *E.METRICS), F.struct(
            F.col("f1"), F.col("best_method") == "gmm")).alias("b"))
        features = F.element_at(F.create_map(*[F.lit(x) for pair in wide.items() for x in pair]), F.col("approach"))
        return _landed(best.select("approach", features.alias("n_features"), *[F.col(f"b.{c}") for c in E.METRICS], "b.best_method"))
    finally:
        for frame in kept:
            frame.unpersist()


def whitened_kmeans(df: DataFrame, key: str, vec: str, label: str, components: int = 15, k: int = 2, n_init: int = 10,
                    max_iter: int = 300) -> tuple[DataFrame, DataFrame]:
    """Standardise, whitened PCA, k-means, six metrics: the labelled rows and the scores."""
    scaled = scale_vector(df, vec, "standard").transform(df, vec, "_s")
    z = R.pca(scaled, "_s", components, True).transform(scaled, "_s", "_z").select(key, label, "_z")
    model = fit_many(z, key, "_z", {"m": Spec(k, n_init)}, max_iter)["m"]  # keeps the rows while it fits
    labelled = model.transform(z, "_z", "cluster")
    return labelled, E.score(labelled, label, "cluster")


def prepare_select_reduce(df: DataFrame, cols: Sequence[str], key: str, label: str, k: int, components: int = 20,
                          methods: Sequence[str] = R.REDUCTIONS, counts: Sequence[int] = (2, 5, 10, 15, 20, 30, 40),
                          n_init: int = 3, max_iter: int = 300) -> tuple[DataFrame, tuple[str, int]]:
    """Winsorise, robust-scale, choose (method, components) by silhouette, reduce."""
    from wideloom.functions.vectors import pack

    ready = handle_outliers(df, cols, "winsorize", 3.0)
    ready = scale(ready, cols, "robust").transform(ready)
    ready = ready.select(key, label, pack(cols).alias("v")).persist()
    try:
        grid = reduction_grid(ready, key, "v", k, methods, counts, n_init, max_iter)
        best = grid.orderBy(F.desc("silhouette"), "method", "n_components").first()
        model = R.reduce_by(ready, key, "v", best["method"], best["n_components"])
    finally:
        ready.unpersist()
    return model.transform(ready, "v", "z").select(key, label, "z"), (best["method"], best["n_components"])


def evaluate_combined(df: DataFrame, key: str, vec: str, label: str, components: int = 20, k: int = 2, n_init: int = 10,
                      pairs: Sequence[tuple[int, int]] = (), max_iter: int = 100) -> DataFrame:
    """The combined approach end to end: reduce, cluster, align, score."""
    z = combined_features(df.select(key, label, F.col(vec).alias("v")), key, "v", components, pairs).persist()
    try:
        model = fit_many(z, key, "v", {"combined": Spec(k, n_init)}, max_iter)
        return _landed(score_models(z, "v", label, model))
    finally:
        z.unpersist()


def explained_variance_check(df: DataFrame, vec: str, k: int) -> DataFrame:
    """Explained-variance ratios of our PCA against Spark ML's, with the squared error."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    mine = R.pca(df, vec, k).ratio
    theirs = PCA(k=k, inputCol="x", outputCol="y").fit(
        df.select(array_to_vector(F.col(vec)).alias("x"))).explainedVariance.toArray()
    return df.sparkSession.createDataFrame(
        [(i + 1, float(a), float(b), float((a - b) ** 2)) for i, (a, b) in enumerate(zip(mine, theirs))],
        "component int, ratio double, ml_ratio double, squared_error double")
