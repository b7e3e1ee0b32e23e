"""Statistics, sources, preparation and scoring."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF, rows
from wideloom.functions import stats as S
from wideloom.operators import evaluate as E
from wideloom.operators import features as FT
from wideloom.operators import prep, profile
from wideloom.operators.quantiles import exact_quantiles
from wideloom.operators.ranks import cumulative
from wideloom.sources import tables as T


def col(spark, values, name="x"):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], f"k int, {name} double")


def test_normal_functions(spark):
    z = [-9.0, -3.0, -0.5, 0.0, 0.1, 1.96, 5.0, 7.5, 12.0]
    got = rows(S.add_normal_tail(col(spark, z), F.col("x"), "p", upper=True), "k", "p")
    want = np.array([0.5 * math.erfc(v / math.sqrt(2)) for v in z])
    near = np.abs(z) < 7  # the far tail is a short continued fraction
    assert np.allclose(got[near], want[near], rtol=1e-13) and np.allclose(got, want, rtol=1e-7, atol=1e-300)
    p = [1e-12, 1e-4, 0.02, 0.3, 0.5, 0.8, 0.999]
    got = rows(S.add_normal_quantile(col(spark, p), F.col("x"), "q"), "k", "q")
    assert np.allclose(got, [NormalDist().inv_cdf(v) for v in p], atol=1e-13)


def test_shapiro_wilk_known_example(spark):
    # Published example: 11 weights, W = 0.79, p = 0.007.
    w = [148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]
    r = profile.shapiro_wilk(col(spark, w), ["x"]).first()
    assert abs(r["w"] - 0.7888) < 1e-4 and abs(r["p_value"] - 0.006704) < 1e-5 and r["rejected"]


def test_mann_whitney_small_example(spark):
    a, b = [1, 2, 2, 5], [3, 4, 4, 6, 7]
    df = spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b], "g string, x double")
    r = profile.mann_whitney(df, ["x"], "g", "a", "b").first()
    assert r["u"] == sum((x > y) + 0.5 * (x == y) for x in a for y in b) and r["n1"] == 4 and r["n2"] == 5
    assert profile.mann_whitney(df, ["x"], "g", "a", "zzz").count() == 0


def test_cumulative_with_a_hot_value_and_many_buckets(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([np.full(300, 5.0), rng.integers(0, 200, 600)])
    got = cumulative(col(spark, v), [], "x", {"t": F.count("*")}, buckets=13).orderBy("x").collect()
    u, n = np.unique(v, return_counts=True)
    assert [r["x"] for r in got] == list(u) and [r["t"] for r in got] == list(n)
    assert [r["before_t"] for r in got] == list(np.concatenate([[0], n.cumsum()[:-1]]))


@pytest.mark.parametrize("kind", ["spread", "hot", "two", "holes"])
def test_exact_quantiles_by_bracketing(spark, kind):
    rng = np.random.default_rng(1)
    v = {"spread": rng.normal(size=30_000), "hot": np.concatenate([np.full(10_000, 3.0), rng.normal(size=20_000)]),
         "two": np.repeat([0.0, 1.0], 10_000), "holes": rng.normal(size=25_000)}[kind]
    df = spark.range(len(v)).join(spark.createDataFrame(list(enumerate(map(float, v))), "id bigint, x double"), "id")
    if kind == "holes":
        df = df.withColumn("x", F.when(F.col("id") % 3 > 0, F.col("x")))
        v = v[np.arange(len(v)) % 3 > 0]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, {"x": F.col("x")}, probs, exact_rows=200)["x"]
    assert np.allclose(got, np.quantile(v, probs), rtol=0, atol=1e-15)


def test_describe_and_missing(spark):
    df = col(spark, [1.0, 2.0, None, float("nan"), 10.0])
    assert profile.missing_counts(df, ["x", "k"]).collect()[0]["missing"] == 2
    r = profile.describe(df, ["x"]).first()
    v = np.array([1.0, 2.0, 10.0])
    m2, m3 = v.var(), ((v - v.mean()) ** 3).mean()
    assert r["count"] == 3 and np.isclose(r["std"], v.std(ddof=1))
    assert np.isclose(r["skewness"], m3 / m2 ** 1.5 * math.sqrt(6) / 1) and r["kurtosis"] is None


def test_many_correlations_take_the_matrix_path(spark, emb, x):
    names = [f"f{i}" for i in range(12)]
    df = emb.select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    got = {(r["a"], r["b"]): r["value"] for r in profile.correlations(df, names).collect()}
    want = np.corrcoef(x[:, :12].T)
    assert all(np.isclose(v, want[int(a[1:]), int(b[1:])]) for (a, b), v in got.items()) and len(got) == 66


def test_yeo_johnson_fit_maximises_the_likelihood(spark):
    rng = np.random.default_rng(2)
    v = rng.gamma(2.0, size=500) - 0.5
    p = prep.fit_yeo_johnson(col(spark, v), ["x"]).params["x"]

    def ll(lam):
        t = prep._yj(v, lam)
        return -len(v) / 2 * math.log(t.var()) + (lam - 1) * (np.sign(v) * np.log1p(np.abs(v))).sum()

    grid = np.linspace(-2, 3, 20001)
    assert abs(p["lambda"] - grid[int(np.argmax([ll(g) for g in grid]))]) < 1e-3
    z = rows(prep.fit_yeo_johnson(col(spark, v), ["x"]).transform(col(spark, v)), "k", "x")
    assert abs(z.mean()) < 1e-9 and abs(z.std() - 1) < 1e-9


def test_scaling_a_constant_column(spark):
    df = col(spark, [4.0, 4.0, 4.0])
    for how in ("standard", "robust", "minmax"):
        assert rows(prep.scale(df, ["x"], how).transform(df), "k", "x").tolist() == [0.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        prep.scale(df, ["x"], "other")


def test_outliers_ignore_nan_and_constants(spark):
    df = spark.createDataFrame([(i, float("nan") if i == 3 else float(i == 9) * 100, 1.0) for i in range(20)],
                               "k int, x double, c double")
    assert [r["k"] for r in prep.outlier_mask(df, ["x", "c"]).where("is_outlier").collect()] == [9]
    with pytest.raises(ValueError):
        prep.handle_outliers(df, ["x"], "other")


def test_zero_imputation_clamps(spark):
    df = col(spark, [None, float("nan"), float("inf"), float("-inf"), 2.0])
    got = rows(prep.impute(df, ["x"], "zero").transform(df), "k", "x")
    assert got.tolist() == [0.0, 0.0, prep.MAX_DOUBLE, -prep.MAX_DOUBLE, 2.0]


def test_site_residuals_have_zero_means(spark):
    df = spark.read.parquet(f"{SF}/customer.parquet")
    out = prep.remove_site_effects(df, ["c_acctbal"], "c_nationkey")
    worst = out.groupBy("c_nationkey").agg(F.abs(F.avg("c_acctbal")).alias("m")).agg(F.max("m")).first()[0]
    assert worst < 1e-9 and out.count() == df.count()


def test_adaptive_preprocess(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(a), float(b), 1.0, "s") for i, (a, b) in enumerate(zip(
        rng.exponential(size=300), rng.normal(size=300)))], "k int, a double, b double, c double, site string")
    out, kept = prep.adaptive_preprocess(df, ["a", "b", "c"])
    assert kept == ["a", "b"] and out.columns == ["k", "a", "b", "site"]
    assert abs(profile.describe(out, ["a"]).first()["skewness"]) < 0.5


# ---- sources -------------------------------------------------------------------------

def test_feature_spec(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, "a")], "k int, fsA double, xfs double, fsText string")
    assert T.FeatureSpec(prefix="fs").resolve(df.schema) == ["fsA"]
    assert T.FeatureSpec(contains="fs").resolve(df.schema) == ["fsA", "xfs"]
    assert T.FeatureSpec(pattern="A$|^k", exclude=("k",)).resolve(df.schema) == ["fsA"]
    with pytest.raises(ValueError):
        T.FeatureSpec(prefix="zz").resolve(df.schema)


def test_labelled_table_needs_its_label(spark):
    with pytest.raises(ValueError):
        T.labelled_table(spark.range(3).toDF("a"), "label", {}, T.FeatureSpec())


def test_reuse_or_build(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    path = str(tmp_path / "t")
    assert T.reuse_or_build(spark, path, build).count() == 5 and T.reuse_or_build(spark, path, build).count() == 5
    assert len(calls) == 1
    T.reuse_or_build(spark, path, build, force=True)
    assert len(calls) == 2


def test_split_sizes_with_one_large_class(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") % 3 == 0, "a").when(F.col("id") < 7, "b").otherwise("c"))
    got = {(r["label"], r["split"]): r["count"] for r in
           T.stratified_split(df, "id", "label", None).groupBy("label", "split").count().collect()}
    for c, n in ((r["label"], r["count"]) for r in df.groupBy("label").count().collect()):
        assert got[(c, "train")] == int(0.7 * n + 0.5) and got[(c, "train")] + got.get((c, "test"), 0) == n


# ---- scoring -----------------------------------------------------------------------------

def labels_frame(spark, y, c, run=None):
    return spark.createDataFrame([(int(a), int(b)) for a, b in zip(y, c)], "label int, cluster int")


def test_perfect_and_relabelled(spark):
    y = np.arange(60) % 3
    for c in (y, (y + 1) % 3, y * 10 - 1):
        r = E.score(labels_frame(spark, y, c), "label", "cluster").first()
        assert all(np.isclose(r[m], 1.0) for m in E.METRICS)


def test_binary_flip_with_noise_label(spark):
    y = np.repeat([0, 1], 10)
    c = np.where(y == 1, -1, 0)  # noise as the second cluster
    assert E.score(labels_frame(spark, y, c), "label", "cluster").first()["accuracy"] == 1.0


def test_single_cluster_is_weighted(spark):
    y = np.array([0] * 6 + [1] * 4)
    r = E.score(labels_frame(spark, y, np.zeros(10)), "label", "cluster").first()
    assert np.isclose(r["accuracy"], 0.6) and np.isclose(r["precision"], 0.36) and r["ari"] == 0.0 and r["nmi"] == 0.0


def test_one_to_one_alignment_beats_majority(spark):
    # Both clusters hold mostly class 0, but a one-to-one map must use two classes.
    y = [0] * 5 + [1] * 4 + [0] * 6 + [2] * 1
    c = [0] * 9 + [1] * 7
    r = E.score(labels_frame(spark, y, c), "label", "cluster").first()
    assert np.isclose(r["accuracy"], (4 + 6) / 16)


def test_assignment_beyond_permutations():
    rng = np.random.default_rng(4)
    m = rng.integers(0, 50, (8, 12)).astype(float)
    pick = E.best_assignment(m)
    assert len(set(pick)) == 8
    small = m[:5, :7]
    import itertools

    best = max(sum(small[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(7), 5))
    assert sum(small[i, j] for i, j in enumerate(E.best_assignment(small))) == best
    greedy = sum(m.max(axis=1))
    assert sum(m[i, j] for i, j in enumerate(pick)) <= greedy


def test_scores_of_several_runs_equal_single_runs(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 3, 90)
    runs = {i: rng.integers(0, i + 2, 90) for i in range(3)}
    df = spark.createDataFrame([(i, int(a), int(b)) for i, c in runs.items() for a, b in zip(y, c)], "run int, label int, cluster int")
    many = {r["run"]: r for r in E.score(df, "label", "cluster", ["run"]).collect()}
    for i, c in runs.items():
        one = E.score(labels_frame(spark, y, c), "label", "cluster").first()
        assert all(np.isclose(many[i][m], one[m]) for m in E.METRICS)


def test_silhouette_by_run(spark, emb, x, y):
    d = ((x[:, None] - x[None]) ** 2).sum(2)

    def brute(lab):
        s = []
        for i in range(len(x)):
            own = lab == lab[i]
            if own.sum() == 1:
                s.append(0.0)
                continue
            a = d[i][own].sum() / (own.sum() - 1)
            b = min(d[i][lab == c].mean() for c in set(lab) if c != lab[i])
            s.append((b - a) / max(a, b))
        return np.mean(s)

    two = emb.select("v", F.explode(F.array(
        F.struct(F.lit("label").alias("run"), F.col("label").alias("c")),
        F.struct(F.lit("half").alias("run"), (F.col("vec_id") < 1).cast("int").alias("c")))).alias("r")).select("v", "r.*")
    got = {r["run"]: r["silhouette"] for r in E.silhouette(two, "v", "c", ["run"]).collect()}
    assert np.isclose(got["label"], brute(y)) and np.isclose(got["half"], brute((np.arange(len(x)) < 1).astype(int)))


def test_ratio_construction(spark):
    df = spark.createDataFrame([(1, 2.0, 4.0), (2, 6.0, 0.0), (3, 9.0, 2.0)], "k int, m_L_a double, m_R_a double")
    pairs = FT.matching_pairs(df.columns)
    assert pairs == [("m_L_a", "m_R_a")]
    assert np.allclose(rows(FT.pair_ratios(df, pairs), "k", "ratio_m_L_a"), [0.5, 3.0, 4.5])
    assert len(FT.variable_ratio_pairs(np.arange(30.0))) == sum(14 - i for i in range(10))


def test_keyword_weights():
    w = FT.keyword_weights(["left_Frontal", "other"])
    assert np.allclose(w, np.array([1.5, 1.0]) / 1.25)
