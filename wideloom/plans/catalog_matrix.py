"""Queries: feature construction and selection, reduction and whitening."""

from __future__ import annotations

from pyspark.sql import functions as F

from wideloom.functions.vectors import pack
from wideloom.operators import features as FT
from wideloom.operators import hierarchy as H
from wideloom.operators import prep
from wideloom.operators import reduce as R
from wideloom.plans import steps as ST
from wideloom.plans.registry import EMB, EMB_LONG, LI, embeddings, query, rnd, rounded

LI_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
LI_KEYS = LI_ID.split(", ")


def _vector_rows(df, vec, k, digits=6, *keep):
    return df.select("vec_id", *keep, *[rnd(F.col(vec)[i], digits).alias(f"c{i}") for i in range(k)])


# ---- selection ------------------------------------------------------------------------------

@query("variance_threshold", f"""
SELECT i, round(var_pop(x), 9) + 0.0 AS variance, var_pop(x) > 0.0155 AS kept FROM
  (SELECT CAST(i AS INTEGER) AS i, x FROM {EMB_LONG}) GROUP BY i""")
def _(spark, table):
    df = embeddings(table)
    kept = FT.variance_threshold(df, "v", 0.0155)
    return rounded(FT.variances(df, "v").withColumn("kept", F.col("i").isin(kept)), "variance", digits=9)


ANOVA = """
WITH c AS (SELECT {key}, label, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM {src} GROUP BY {key}, label),
t AS (SELECT {key}, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS g, sum(n * v) AS w FROM c GROUP BY {key}),
f AS (SELECT {key}, (sum(c.n * (m - g) ** 2) / (any_value(k) - 1)) / (any_value(w) / (any_value(t.n) - any_value(k))) AS f
  FROM c JOIN t USING ({key}) GROUP BY {key})"""


@query("anova_f", ANOVA.format(key="i", src=EMB_LONG) + "SELECT CAST(i AS INTEGER) AS i, round(f, 6) + 0.0 AS f FROM f")
def _(spark, table):
    return rounded(FT.anova_f(embeddings(table), "v", "label"), "f")


@query("anova_k_best", ANOVA.format(key="i", src=EMB_LONG) +
       "SELECT CAST(i AS INTEGER) AS i FROM f ORDER BY f DESC, i LIMIT 10")
def _(spark, table):
    scores = FT.anova_f(embeddings(table), "v", "label")
    return scores.where(F.col("i").isin(FT.k_best(scores, "f", 10))).select("i")


MI = f"""
WITH e AS (SELECT i, min(x) AS lo, (max(x) - min(x)) / 10 AS w FROM {EMB_LONG} GROUP BY i),
b AS (SELECT i, label, least(floor((x - lo) / w), 9) AS b FROM {EMB_LONG} JOIN e USING (i)),
c AS (SELECT i, label, b, count(*) AS n FROM b GROUP BY i, label, b),
m AS (SELECT i, n, sum(n) OVER (PARTITION BY i, b) AS nb, sum(n) OVER (PARTITION BY i, label) AS ny,
  sum(n) OVER (PARTITION BY i) AS t FROM c),
s AS (SELECT CAST(i AS INTEGER) AS i, sum(n / t * ln(n * t / (nb * ny))) AS mi FROM m GROUP BY i)"""


@query("binned_mutual_information", MI + "SELECT i, round(mi, 6) + 0.0 AS mi FROM s")
def _(spark, table):
    return rounded(FT.binned_mutual_information(embeddings(table), "v", "label"), "mi")


CHI2 = f"""
WITH l AS (SELECT least(min(x), 0.0) AS low FROM {EMB_LONG}),
o AS (SELECT i, label, sum(x - low) AS o, count(*) AS n FROM {EMB_LONG}, l GROUP BY i, label),
e AS (SELECT i, o, n / sum(n) OVER (PARTITION BY i) * sum(o) OVER (PARTITION BY i) AS e FROM o),
s AS (SELECT CAST(i AS INTEGER) AS i, sum((o - e) ** 2 / e) AS chi2 FROM e GROUP BY i)"""


@query("chi2_scores", CHI2 + "SELECT i, round(chi2, 6) + 0.0 AS chi2 FROM s")
def _(spark, table):
    return rounded(FT.chi2(embeddings(table), "v", "label"), "chi2")


@query("select_percentile", CHI2 + "SELECT i FROM s WHERE chi2 > (SELECT quantile_cont(chi2, 0.7) FROM s)")
def _(spark, table):
    scores = FT.chi2(embeddings(table), "v", "label")
    return scores.where(F.col("i").isin(FT.best_percentile(scores, "chi2", 30))).select("i")


PAIR_ALL = f"(SELECT a.i AS a, b.i AS b, a.label, a.x * b.x AS x FROM {EMB_LONG} a JOIN {EMB_LONG} b ON a.vec_id = b.vec_id AND a.i < b.i)"


PAIR_F = ANOVA.format(key="a, b", src=PAIR_ALL) + (
    "SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, round(f, 6) + 0.0 AS f FROM f ORDER BY f DESC, a, b LIMIT 10")


@query("pair_f_test", PAIR_F)
@query("pair_f_test_all", PAIR_F)
def _(spark, table):
    return rounded(FT.pair_products(embeddings(table), "v", "label", range(64)), "f")


@query("forest_importance")
def _(spark, table):
    return FT.importance_table(embeddings(table), "v", "label", 20, 20)


@query("select_from_model")
def _(spark, table):
    imp = FT.forest_importance(embeddings(table), "v", "label", 20)
    chosen = FT.select_from_model(imp, "mean", 50)
    return _vector_rows(embeddings(table).withColumn("z", FT.take("v", chosen)), "z", len(chosen))


@query("discriminative_pairs")
def _(spark, table):
    return rounded(FT.discriminative_pairs(embeddings(table), "v", "label", 20, 10, 20), "f", "p_value")


# ---- construction -----------------------------------------------------------------------------

def _poly(name, interaction_only):
    terms = FT.poly_terms(4, 2, interaction_only)
    exprs = ", ".join(f"round({' * '.join(LI[t] for t in term)}, 4) + 0.0 AS \"{'*'.join(LI[t] for t in term)}\"" for term in terms)

    @query(name, f"SELECT {LI_ID.replace('l_orderkey', 'l_orderkey AS k1').replace('l_linenumber', 'l_linenumber AS k2')}, {exprs} FROM lineitem")
    def _(spark, table):
        out = FT.polynomial_columns(LI, 2, interaction_only)
        return table("lineitem").select(F.col("l_orderkey").alias("k1"), F.col("l_linenumber").alias("k2"), "l_partkey",
                                        "l_suppkey", *[rnd(e, 4).alias(n) for n, e in out.items()])


_poly("polynomial_features", False)
_poly("interaction_features", True)


@query("pair_ratios", f"""
SELECT {LI_ID}, round(l_discount / coalesce(nullif(l_tax, 0.0), (SELECT avg(l_tax) FROM lineitem)), 6) + 0.0 AS ratio_l_discount
FROM lineitem""")
def _(spark, table):
    out = FT.pair_ratios(table("lineitem"), [("l_discount", "l_tax")])
    return rounded(out.select(*LI_KEYS, "ratio_l_discount"), "ratio_l_discount")


# Columns by falling variance.  A ratio by a value next to zero is huge, so its inverse is compared.
BY_VARIANCE = ["l_extendedprice", "l_quantity", "l_discount", "l_tax"]
RATIO_PAIRS = [(a, b) for i, a in enumerate(BY_VARIANCE) for b in BY_VARIANCE[i + 1:]]


@query("variable_ratios", f"SELECT {LI_ID}, " + ", ".join(
    f'round(({b} + 1e-10) / nullif({a}, 0), 7) + 0.0 AS "{a}/{b}"' for a, b in RATIO_PAIRS) + " FROM lineitem")
def _(spark, table):
    out = FT.variable_ratios(table("lineitem"), LI)
    return out.select(*LI_KEYS, *[rnd(1 / F.nullif(F.col(f"ratio_{a}_{b}"), F.lit(0.0)), 7).alias(f"{a}/{b}")
                                  for a, b in RATIO_PAIRS])


@query("keyword_weights", """
WITH w AS (SELECT p_partkey, p_size, CASE WHEN lower(p_type) LIKE '%brass%' OR lower(p_type) LIKE '%steel%' THEN 1.5 ELSE 1.0 END AS w
  FROM part)
SELECT p_partkey, round(p_size * w / (SELECT avg(w) FROM (SELECT DISTINCT p_type, CASE WHEN lower(p_type) LIKE '%brass%'
  OR lower(p_type) LIKE '%steel%' THEN 1.5 ELSE 1.0 END AS w FROM part)), 6) + 0.0 AS weighted FROM w""")
def _(spark, table):
    # Weights of named features, applied to the rows that carry the name.
    part = table("part").select("p_partkey", "p_type", "p_size")
    names = sorted(r[0] for r in part.select("p_type").distinct().collect())
    w = FT.keyword_weights(names, ("brass", "steel"))
    weights = spark.createDataFrame(list(zip(names, map(float, w))), "p_type string, w double")
    return part.join(F.broadcast(weights), "p_type").select("p_partkey", rnd(F.col("p_size") * F.col("w")).alias("weighted"))


@query("concat_blocks", f"""
SELECT vec_id, len(v) + 4 AS width, round(list_sum(v) + list_sum(v[1:4]), 6) + 0.0 AS total FROM {EMB}""")
def _(spark, table):
    df = embeddings(table).withColumn("head", F.slice("v", 1, 4)).withColumn("both", FT.concat_blocks("v", "head"))
    return df.select("vec_id", F.size("both").cast("bigint").alias("width"),
                     rnd(F.aggregate("both", F.lit(0.0), lambda s, x: s + x)).alias("total"))


@query("feature_agglomeration")
def _(spark, table):
    df = embeddings(table)
    return _vector_rows(H.feature_agglomeration(df, "v", 10).transform(df, "v", "z"), "z", 10)


@query("corr_graph_edges", f"""
SELECT CAST(a.i AS INTEGER) AS src, CAST(b.i AS INTEGER) AS dst, round(abs(corr(a.x, b.x)), 6) + 0.0 AS weight
FROM {EMB_LONG} a JOIN {EMB_LONG} b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i HAVING abs(corr(a.x, b.x)) > 0.1""")
def _(spark, table):
    edges = FT.correlation_edges(R.gram(embeddings(table), "v"), 0.1)
    return rounded(spark.createDataFrame(edges, "src int, dst int, weight double"), "weight")


@query("graph_selection_pca")
def _(spark, table):
    df = embeddings(table)
    return _vector_rows(FT.graph_selection_pca(df, "v", 10, 0.1, 40).transform(df, "v", "z"), "z", 10)


# ---- Gram matrix and two-feature closed forms ----------------------------------------------------

@query("gram_covariance", f"""
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.x, b.x), 9) + 0.0 AS cov
FROM {EMB_LONG} a JOIN {EMB_LONG} b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def _(spark, table):
    return rounded(R.gram_rows(embeddings(table), "v"), "cov", digits=9)


# Every seventh vector misses an entry, every 50th misses all but the first.
HOLED = f"""(SELECT vec_id, i, CASE WHEN (vec_id % 7 = 0 AND i = vec_id % 64) OR (vec_id % 50 = 0 AND i > 0) THEN NULL ELSE x END AS x
  FROM {EMB_LONG})"""


@query("holed_embeddings_gram", f"""
WITH f AS (SELECT vec_id, i, coalesce(x, avg(x) OVER (PARTITION BY i)) AS x FROM {HOLED})
SELECT CAST(a.i AS INTEGER) AS i, CAST(b.i AS INTEGER) AS j, round(covar_samp(a.x, b.x), 9) + 0.0 AS cov
FROM f a JOIN f b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""")
def _(spark, table):
    cols = [f"f{i}" for i in range(64)]
    k = F.col("vec_id")
    wide = embeddings(table).select("vec_id", *[F.when(~((k % 7 == 0) & (k % 64 == i) | (k % 50 == 0) & F.lit(i > 0)), F.col("v")[i])
                                                .alias(c) for i, c in enumerate(cols)])
    full = prep.impute(wide, cols, "mean").transform(wide)
    return rounded(R.gram_rows(full.select(pack(cols).alias("v")), "v"), "cov", digits=9)


@query("kernel_cosine_gram", f"""
WITH u AS (SELECT vec_id, i, x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)) AS x FROM {EMB_LONG}),
c AS (SELECT a.i AS i, b.i AS j, covar_samp(a.x, b.x) * (count(*) - 1) AS c FROM u a JOIN u b USING (vec_id) GROUP BY a.i, b.i)
SELECT round(sum(c) FILTER (WHERE i = j), 7) + 0.0 AS total, round(sum(c * c), 5) + 0.0 AS squares FROM c""")
def _(spark, table):
    w = R.kernel_pca(embeddings(table), "vec_id", "v", 64, "cosine").explained
    return rounded(rounded(spark.createDataFrame([(float(w.sum()), float((w * w).sum()))], "total double, squares double"),
                           "total", digits=7), "squares", digits=5)


@query("kernel_linear_gram", f"""
WITH c AS (SELECT a.i AS i, b.i AS j, covar_samp(a.x, b.x) * (count(*) - 1) AS c FROM {EMB_LONG} a JOIN {EMB_LONG} b USING (vec_id)
  GROUP BY a.i, b.i)
SELECT round(sum(c) FILTER (WHERE i = j), 6) + 0.0 AS total, round(sum(c * c), 4) + 0.0 AS squares FROM c""")
def _(spark, table):
    w = R.kernel_pca(embeddings(table), "vec_id", "v", 64, "linear").explained
    return rounded(rounded(spark.createDataFrame([(float(w.sum()), float((w * w).sum()))], "total double, squares double"),
                           "total", digits=6), "squares", digits=4)


@query("pca_spectrum", f"""
WITH c AS (SELECT a.i AS i, b.i AS j, covar_samp(a.x, b.x) AS c FROM {EMB_LONG} a JOIN {EMB_LONG} b USING (vec_id)
  GROUP BY a.i, b.i)
SELECT CAST(64 AS INTEGER) AS components, round(sum(c) FILTER (WHERE i = j), 9) + 0.0 AS total,
  round(sum(c * c), 9) + 0.0 AS squares FROM c""")
def _(spark, table):
    # Sum and sum of squares of the eigenvalues are the trace and squared norm of the covariance.
    m = R.pca(embeddings(table), "v")
    return rounded(spark.createDataFrame([(len(m.explained), float(m.explained.sum()), float((m.explained ** 2).sum()))],
                                         "components int, total double, squares double"), "total", "squares", digits=9)


# x = quantity, y = price / 1000: covariance (a, b; b, c), eigenvalues l1 >= l2, first axis at angle t.
TWO = """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS x, l_quantity / 10 + l_extendedprice / 5000 AS y
  FROM lineitem),
s AS (SELECT avg(x) AS mx, avg(y) AS my, var_samp(x) AS a, covar_samp(x, y) AS b, var_samp(y) AS c, count(*) AS n FROM d),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS l1, (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b) AS l2,
  a * c - b * b AS det FROM s),
p AS (SELECT *, b / sqrt(b * b + (l1 - a) ** 2) AS u, (l1 - a) / sqrt(b * b + (l1 - a) ** 2) AS w FROM e),
q AS (SELECT *, CASE WHEN abs(u) >= abs(w) THEN sign(u) ELSE sign(w) END * u AS u1,
  CASE WHEN abs(u) >= abs(w) THEN sign(u) ELSE sign(w) END * w AS w1 FROM p),
r AS (SELECT *, CASE WHEN abs(w1) >= abs(u1) THEN sign(-w1) ELSE sign(u1) END * -w1 AS u2,
  CASE WHEN abs(w1) >= abs(u1) THEN sign(-w1) ELSE sign(u1) END * u1 AS w2 FROM q)
"""


def _two(table):
    return table("lineitem").select(*LI_KEYS, pack([F.col("l_quantity"), F.col("l_quantity") / 10 + F.col("l_extendedprice") / 5000]).alias("v"))


def _two_query(name, c0, c1, fit):
    @query(name, TWO + f"SELECT {LI_ID}, round({c0}, 5) + 0.0 AS c0, round({c1}, 5) + 0.0 AS c1 FROM d, r")
    def _(spark, table):
        df = _two(table)
        out = fit(df).transform(df, "v", "z")
        return out.select(*LI_KEYS, *[rnd(F.col("z")[i], 5).alias(f"c{i}") for i in range(2)])


S1, S2 = "((x - mx) * u1 + (y - my) * w1)", "((x - mx) * u2 + (y - my) * w2)"
_two_query("pca_scores", S1, S2, lambda df: R.pca(df, "v", 2))
_two_query("pca_whitened", f"{S1} / sqrt(l1)", f"{S2} / sqrt(l2)", lambda df: R.pca(df, "v", 2, True))
_two_query("double_pca", S1, S2, lambda df: R.double_pca(df, "v", 2))
ZC = "({s1} / sqrt(l1 + 1e-6) * {f1} + {s2} / sqrt(l2 + 1e-6) * {f2})"
_two_query("zca_whitening", ZC.format(s1=S1, s2=S2, f1="u1", f2="u2"), ZC.format(s1=S1, s2=S2, f1="w1", f2="w2"),
           lambda df: R.whiten(df, "v", "zca"))
_two_query("mahalanobis_whitening", ZC.format(s1=S1, s2=S2, f1="u1", f2="u2"), ZC.format(s1=S1, s2=S2, f1="w1", f2="w2"),
           lambda df: R.whiten(df, "v", "mahalanobis"))
# L = (l11, 0; l21, l22), scores (x, y) L^-T.
_two_query("cholesky_whitening", "(x - mx) / sqrt(a + 1e-6)",
           "((y - my) - b / (a + 1e-6) * (x - mx)) / sqrt(c + 1e-6 - b * b / (a + 1e-6))", lambda df: R.whiten(df, "v", "cholesky"))
_two_query("adaptive_whitening", f"{S1} * pow(l1, 0.3) / sqrt(l1 + 1e-6)", f"{S2} * pow(l2, 0.3) / sqrt(l2 + 1e-6)",
           lambda df: R.whiten(df, "v", "adaptive", alpha=0.7))
HY = "(0.5 * ({s1} / sqrt(l1) * {f1} + {s2} / sqrt(l2) * {f2}) + 0.5 * {s} * pow({l}, 0.3) / sqrt({l}))"
_two_query("hybrid_whitening", HY.format(s1=S1, s2=S2, f1="u1", f2="u2", s=S1, l="l1"),
           HY.format(s1=S1, s2=S2, f1="w1", f2="w2", s=S2, l="l2"), lambda df: R.whiten(df, "v", "hybrid"))


@query("svd_scores", """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS x, l_quantity / 10 + l_extendedprice / 5000 AS y
  FROM lineitem),
s AS (SELECT sum(x * x) AS a, sum(x * y) AS b, sum(y * y) AS c FROM d),
p AS (SELECT b, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) - a AS g FROM s),
q AS (SELECT abs(b) / sqrt(b * b + g * g) AS u, sign(b) * g / sqrt(b * b + g * g) AS w FROM p)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(x * u + y * w, 5) + 0.0 AS c0,
  round(CASE WHEN abs(w) >= abs(u) THEN sign(w) ELSE -1 END * (x * w - y * u), 5) + 0.0 AS c1
FROM d, q""")
def _(spark, table):
    df = _two(table)
    out = R.truncated_svd(df, "v", 2).transform(df, "v", "z")
    return out.select(*LI_KEYS, *[rnd(F.col("z")[i], 5).alias(f"c{i}") for i in range(2)])


@query("explained_variance", TWO + """
SELECT CAST(1 AS INTEGER) AS component, round(l1 / (l1 + l2), 9) + 0.0 AS ratio, round(l1 / (l1 + l2), 9) + 0.0 AS cumulative,
  l1 / (l1 + l2) >= 0.8 AS reaches_80, l1 / (l1 + l2) >= 0.9 AS reaches_90 FROM e UNION ALL
SELECT 2, round(l2 / (l1 + l2), 9) + 0.0, 1.0, true, true FROM e""")
def _(spark, table):
    df = _two(table)
    return rounded(R.explained_variance(R.pca(df, "v", 2), df), "ratio", "cumulative", digits=9)


@query("whitening_comparison", """
WITH n AS (SELECT unnest(['pca_whiten', 'zca', 'cholesky', 'mahalanobis', 'adaptive_1.0']) AS method),
g AS (SELECT unnest([0, 1]) AS i), h AS (SELECT unnest([0, 1]) AS j)
SELECT method, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CASE WHEN i = j THEN 1.0 ELSE 0.0 END AS cov FROM n, g, h""")
def _(spark, table):
    out = R.compare_whitening(embeddings(table), "v", 2)
    return rounded(out.where(F.col("method").isin("pca_whiten", "zca", "cholesky", "mahalanobis", "adaptive_1.0")), "cov", digits=3)


@query("whitening_comparison_all")
def _(spark, table):
    return rounded(R.compare_whitening(embeddings(table), "v", 2), "cov", digits=3)


# ---- reductions without a closed form: scores compared in the tests ---------------------------------

def _scores(name, k, fit):
    @query(name)
    def _(spark, table):
        df = embeddings(table)
        return _vector_rows(fit(df).transform(df, "v", "z"), "z", k)


_scores("pca_95_percent", 20, lambda df: R.pca(df, "v", 0.95))
_scores("pca_whitened_20", 20, lambda df: R.pca(df, "v", 20, True))
_scores("polynomial_pca", 10, lambda df: R.polynomial_pca(df, "v", 10, 2))
_scores("truncated_svd", 10, lambda df: R.truncated_svd(df, "v", 10))
_scores("kernel_pca_rbf", 10, lambda df: R.kernel_pca(df, "vec_id", "v", 10))
_scores("kernel_pca_poly", 10, lambda df: R.kernel_pca(df, "vec_id", "v", 10, "poly"))
_scores("kernel_pca_sigmoid", 10, lambda df: R.kernel_pca(df, "vec_id", "v", 10, "sigmoid"))
_scores("kernel_pca_cosine", 10, lambda df: R.kernel_pca(df, "vec_id", "v", 10, "cosine"))
_scores("ica", 5, lambda df: R.ica(df, "v", 5, 100))
_scores("nmf", 5, lambda df: R.nmf(df, "v", 5))
_scores("random_projection", 10, lambda df: R.random_projection(df, "v", 10))
_scores("dictionary_learning", 5, lambda df: R.dictionary_learning(df, "v", 5, 0.1))
_scores("zca_pca", 10, lambda df: R.whiten(df, "v", "zca", 10))
_scores("cholesky_pca", 10, lambda df: R.whiten(df, "v", "cholesky", 10))
_scores("mahalanobis_pca", 10, lambda df: R.whiten(df, "v", "mahalanobis", 10))
_scores("adaptive_first", 10, lambda df: R.whiten(df, "v", "adaptive", 10, alpha=0.7))
_scores("hybrid_pca", 10, lambda df: R.whiten(df, "v", "hybrid", 10))
for _m in R.REDUCTIONS:
    _scores(f"reduce_by_{_m}", 5, lambda df, m=_m: R.reduce_by(df, "vec_id", "v", m, 5))


def _frames(name, k, fn):
    @query(name)
    def _(spark, table):
        return _vector_rows(fn(embeddings(table)), "v", k)


_frames("default_steps", 10, lambda df: ST.run_steps(df, "vec_id", "v", components=10))
_frames("step_chain", 5, lambda df: ST.run_steps(df, "vec_id", "v", [
    {"name": "scaling", "type": "robust"}, {"name": "select_percentile", "percentile": 50},
    {"name": "feature_agglomeration", "n_clusters": 12}, {"name": "truncated_svd", "n_components": 5}], "label"))
_frames("ensemble_reduction", 10, lambda df: ST.ensemble_reduction(df, "vec_id", "v", 10, 50))
_frames("auto_features", 20, lambda df: ST.auto_features(df, "vec_id", "v", 20))
_frames("clustering_features", 10, lambda df: ST.clustering_features(df, "vec_id", "v", 10, True))
_frames("combined_features", 10, lambda df: ST.combined_features(df, "vec_id", "v", 10, [(i, i + 32) for i in range(4)]))


@query("reduction_views")
def _(spark, table):
    df = embeddings(table)
    g = R.gram(df, "v")
    models = {"pca": R.pca_from_gram(g, 2), "pca_whitened": R.pca_from_gram(g, 2, True),
              "svd": R.truncated_svd(df, "v", 2), "kernel_pca": R.kernel_pca(df, "vec_id", "v", 2),
              **{m: R.whiten_from_gram(g, m, 2) for m in ("zca", "adaptive")}}
    return rounded(ST.two_component_view(df, "vec_id", "v", "label", models), "c1", "c2")


@query("variance_interactions")
def _(spark, table):
    df = embeddings(table)
    return _vector_rows(ST.variance_interactions(df, "vec_id", "v", "label", 10, 0.01), "v", 10)


@query("explained_variance_check", f"""
WITH c AS (SELECT a.i AS i, b.i AS j, covar_samp(a.x, b.x) AS c FROM {EMB_LONG} a JOIN {EMB_LONG} b USING (vec_id) GROUP BY a.i, b.i)
SELECT count(DISTINCT i) AS components, round(sum(c * c) / pow(sum(c) FILTER (WHERE i = j), 2), 9) + 0.0 AS squared_ratios,
  round(sum(c * c) / pow(sum(c) FILTER (WHERE i = j), 2), 9) + 0.0 AS ml_squared_ratios, count(DISTINCT i) AS equal FROM c""")
def _(spark, table):
    from wideloom.plans.sweeps import explained_variance_check

    # The ratios' squares sum to |C|^2 / trace(C)^2, which needs no eigenvalues.
    out = explained_variance_check(embeddings(table), "v", 64).agg(
        F.count("*").alias("components"), F.sum(F.col("ratio") ** 2).alias("squared_ratios"),
        F.sum(F.col("ml_ratio") ** 2).alias("ml_squared_ratios"), F.count_if(F.col("squared_error") < 1e-15).alias("equal"))
    return rounded(out, "squared_ratios", "ml_squared_ratios", digits=9)


