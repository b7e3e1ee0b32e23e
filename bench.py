"""Times the headline queries on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "describe_moments", "skew_buckets", "mann_whitney", "top_corr_pairs", "iqr_outliers", "preprocessing_advice",
    "outliers_winsorized", "stratified_split", "kde_1d", "impute_median", "scale_standard", "scale_robust",
    "yeo_johnson_fit", "site_residual", "variance_threshold", "anova_f", "chi2_scores", "binned_mutual_information",
    "pair_f_test", "interaction_features", "gram_covariance", "pca_whitened", "zca_whitening", "kernel_pca_rbf",
    "ica", "nmf", "lloyd_step_3", "kmeans_fit", "enhanced_kmeans_euclidean", "gmm_full", "nearest_neighbor",
    "dbscan_labels", "agglomerative_ward", "mean_shift", "scores_majority", "silhouette", "component_sweep",
    "whitened_kmeans",
]


def main() -> None:
    from wideloom.session import local_session

    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(cpus, "bench", os.environ.get("BENCH_MEMORY", "8g"))
    spark.sparkContext.setLogLevel("ERROR")
    from wideloom.plans.catalog import QUERIES

    # One untimed query starts the JVM's and the Python workers' machinery.
    QUERIES["whitened_kmeans"](spark, sf_dir.rsplit("/", 1)[0] + "/sf0.001").collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
