"""Queries: clustering, scoring of clusters and sweeps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from wideloom.operators import affinity as AP
from wideloom.operators import dbscan as DB
from wideloom.operators import evaluate as E
from wideloom.operators import gmm as G
from wideloom.operators import hierarchy as H
from wideloom.operators import kmeans as K
from wideloom.operators import meanshift as MS
from wideloom.operators import neighbors as N
from wideloom.operators import reduce as R
from wideloom.plans import sweeps as SW
from wideloom.plans.registry import EMB, EMB_LONG, embeddings, query, rnd, rounded

SCORES = list(E.METRICS)


def _first_rows(table, k):
    """Start centers: the vectors of the k lowest keys."""
    rows = embeddings(table).orderBy("vec_id").limit(k).collect()
    return np.array([r["v"] for r in rows])


def _z(table, k=10):
    """Whitened components of the embeddings."""
    df = embeddings(table)
    return R.pca(df, "v", k, True).transform(df, "v", "z").select("vec_id", "label", "z")


# ---- Lloyd steps from given centers ------------------------------------------------------------

def _lloyd_sql(steps: int, k: int = 4, agg: str = "avg") -> str:
    """CTEs c0..cN of (j, c): centers after each step; ``a`` assigns rows to the last."""
    out = f"""WITH e AS (SELECT vec_id, label, v FROM {EMB}),
c0 AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS j, v AS c FROM (SELECT * FROM e ORDER BY vec_id LIMIT {k}))"""
    for s in range(steps + 1):
        out += f""", d{s} AS (SELECT vec_id, label, v, j, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) ** 2)) AS d
  FROM e, c{s}),
a{s} AS (SELECT vec_id, any_value(label) AS label, any_value(v) AS v, arg_min(j, (d, j)) AS j, min(d) AS d FROM d{s} GROUP BY vec_id)"""
        if s < steps:
            out += f""", m{s} AS (SELECT j, i, {agg}(x) AS x FROM (SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{s}) GROUP BY j, i),
c{s + 1} AS (SELECT j, list(x ORDER BY i) AS c FROM m{s} GROUP BY j)"""
    return out


CENTERS = "SELECT CAST(j AS INTEGER) AS cluster, CAST(unnest(generate_series(0, 63)) AS INTEGER) AS i, round(unnest(c), 9) + 0.0 AS center FROM c{}"


def _lloyd(steps):
    @query(f"lloyd_step_{steps}", _lloyd_sql(steps) + CENTERS.format(steps))
    def _(spark, table):
        df, c = embeddings(table), _first_rows(table, 4)
        for _ in range(steps):
            c = K.lloyd_step(df, "v", c)
        return rounded(K.centers_frame(df, c), "center", digits=9)


for _s in (1, 2, 3):
    _lloyd(_s)


@query("median_step", _lloyd_sql(1, 3, "median") + CENTERS.format(1))
def _(spark, table):
    df = embeddings(table)
    return rounded(K.centers_frame(df, K.median_step(df, "v", _first_rows(table, 3))), "center", digits=9)


@query("kmeans_from_centers", _lloyd_sql(5) + "SELECT vec_id, CAST(j AS INTEGER) AS cluster FROM a5")
def _(spark, table):
    df = embeddings(table)
    model = K.fit_many(df, "vec_id", "v", {"m": K.Spec(4, init=_first_rows(table, 4))}, max_iter=5, tol=0.0)["m"]
    return model.transform(df, "v").select("vec_id", "cluster")


@query("kmeans_inertia", _lloyd_sql(2) +
       "SELECT CAST(j AS INTEGER) AS cluster, count(*) AS rows, round(sum(d), 6) + 0.0 AS inertia FROM a2 GROUP BY j")
def _(spark, table):
    df, c = embeddings(table), _first_rows(table, 4)
    for _ in range(2):
        c = K.lloyd_step(df, "v", c)
    return rounded(K.inertia_by_cluster(df, "v", c), "inertia")


@query("cluster_importance", f"""
WITH v AS (SELECT label, i, var_pop(x) AS v, count(*) AS n FROM {EMB_LONG} GROUP BY label, i HAVING count(*) > 1),
w AS (SELECT i, sum(1 / (v + 1e-10)) AS w FROM v GROUP BY i)
SELECT CAST(i AS INTEGER) AS i, round(w / sum(w) OVER (), 9) + 0.0 AS importance FROM w""")
def _(spark, table):
    return rounded(K.cluster_importance(embeddings(table), "v", "label"), "importance", digits=9)


def _enhanced_steps(metric, dist):
    sql = _lloyd_sql(2, 3, "median").replace("list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) ** 2))", dist)
    # The second step is damped by 1 / 1.1 and carries a tenth of the first.
    sql = sql.replace("c2 AS (SELECT j, list(x ORDER BY i) AS c FROM m1 GROUP BY j)", """c2 AS (
  SELECT j, list(o[i] + (x - o[i]) / 1.1 + 0.1 * (o[i] - s[i]) ORDER BY i) AS c
  FROM m1 JOIN (SELECT j, c AS o FROM c1) USING (j) JOIN (SELECT j, c AS s FROM c0) USING (j) GROUP BY j)""")

    @query(f"enhanced_steps_{metric}", sql + CENTERS.format(2).replace(", 9)", ", 6)"))
    def _(spark, table):
        df = embeddings(table)
        spec = K.Spec(3, metric=metric, enhanced=True, init=_first_rows(table, 3))
        return rounded(K.centers_frame(df, K.fit_many(df, "vec_id", "v", {"m": spec}, 2, 0.0)["m"].centers), "center")


_enhanced_steps("euclidean", "list_distance(v, c)")
_enhanced_steps("manhattan", "list_sum(list_transform(list_zip(v, c), lambda p: abs(p[1] - p[2])))")
_enhanced_steps("cosine", "1 - list_cosine_similarity(v, c)")


# ---- full fits ------------------------------------------------------------------------------------

@query("kmeans_fit")
def _(spark, table):
    z = _z(table)
    return K.kmeans(z, "vec_id", "z", 10).transform(z, "z").select("vec_id", "cluster")


def _enhanced(metric):
    @query(f"enhanced_kmeans_{metric}")
    def _(spark, table):
        z = _z(table)
        return K.enhanced_kmeans(z, "vec_id", "z", 2, metric).transform(z, "z").select("vec_id", "cluster")


for _m in K.METRICS:
    _enhanced(_m)


def _gmm(kind):
    @query(f"gmm_{kind}")
    def _(spark, table):
        z = _z(table, 5)
        m = G.gmm(z, "vec_id", "z", 3, kind)
        p = z.withColumn("p", m.predict_proba("z"))
        return p.select("vec_id", m.predict("z").alias("cluster"), *[rnd(F.col("p")[j]).alias(f"p{j}") for j in range(3)],
                        rnd(m.score_samples("z")).alias("log_likelihood"))


for _c in G.COVARIANCES:
    _gmm(_c)


# One component fitted by moments: the log-likelihood is the Gaussian density of all rows.
@query("gmm_bic_aic", """
WITH d AS (SELECT l_quantity AS x, l_discount * 100 AS y FROM lineitem),
s AS (SELECT avg(x) AS mx, avg(y) AS my, var_pop(x) + 1e-6 AS a, covar_pop(x, y) AS b, var_pop(y) + 1e-6 AS c FROM d),
l AS (SELECT sum(-ln(2 * pi()) - 0.5 * ln(a * c - b * b) - 0.5 * ((x - mx) ** 2 * c - 2 * (x - mx) * (y - my) * b + (y - my) ** 2 * a)
  / (a * c - b * b)) AS ll, count(*) AS n FROM d, s)
SELECT round(-2 * ll + 5 * ln(n), 3) + 0.0 AS bic, round(-2 * ll + 10, 3) + 0.0 AS aic FROM l""")
def _(spark, table):
    df = table("lineitem").select(F.xxhash64("*").alias("k"), F.array("l_quantity", F.col("l_discount") * 100).alias("v"))
    m = G.gmm(df, "k", "v", 1, max_iter=5, init="random")
    return rounded(spark.createDataFrame([(m.criterion(df, "v", "bic"), m.criterion(df, "v", "aic"))], "bic double, aic double"),
                   "bic", "aic", digits=3)


def _em_sql(rounds: int) -> str:
    out = """WITH p0 AS (SELECT [0.5, 0.5] AS w, [5.0, 100.0] AS m, [var_pop(value) + 1e-6, var_pop(value) + 1e-6] AS s FROM events)"""
    for r in range(rounds):
        out += f""", j{r} AS (SELECT value, list_transform([1, 2], lambda k: w[k] / sqrt(2 * pi() * s[k]) * exp(-0.5 * (value - m[k]) ** 2 / s[k])) AS j
  FROM events, p{r}),
r{r} AS (SELECT value, j[1] / (j[1] + j[2]) AS a, j[2] / (j[1] + j[2]) AS b FROM j{r}),
t{r} AS (SELECT count(*) AS n, sum(a) AS na, sum(b) AS nb, sum(a * value) AS sa, sum(b * value) AS sb, sum(a * value * value) AS qa,
  sum(b * value * value) AS qb FROM r{r}),
p{r + 1} AS (SELECT [na / n, nb / n] AS w, [sa / na, sb / nb] AS m, [qa / na - (sa / na) ** 2 + 1e-6, qb / nb - (sb / nb) ** 2 + 1e-6] AS s FROM t{r})"""
    return out + f""" SELECT CAST(unnest([0, 1]) AS INTEGER) AS component, round(unnest(w), 6) + 0.0 AS weight, round(unnest(m), 5) + 0.0 AS mean,
  round(unnest(s), 4) + 0.0 AS variance FROM p{rounds}"""


@query("gmm_em_rounds", _em_sql(4))
def _(spark, table):
    df = table("events").select("event_id", F.array("value").alias("v"))
    g = G.gmm(df, "event_id", "v", 2, max_iter=4, tol=0.0, init=np.array([[5.0], [100.0]]))
    out = spark.createDataFrame([(k, float(g.weights[k]), float(g.means[k, 0]), float(g.covariances[k, 0, 0])) for k in range(2)],
                                "component int, weight double, mean double, variance double")
    return rounded(rounded(rounded(out, "weight"), "mean", digits=5), "variance", digits=4)


@query("gmm_component_search")
def _(spark, table):
    z = _z(table, 3)
    return rounded(G.best_component_count(z, "vec_id", "z", 5, "bic")[1], "score", digits=3)


@query("gmm_top_two", f"""
WITH e AS (SELECT vec_id, [v[1], v[2], v[3], v[4]] AS s FROM {EMB}),
p AS (SELECT vec_id, list_transform(s, lambda x: exp(x) / list_sum(list_transform(s, lambda y: exp(y)))) AS p FROM e),
m AS (SELECT j, sum(r) AS m FROM (SELECT unnest(p) AS r, generate_subscripts(p, 1) AS j FROM p) GROUP BY j),
t AS (SELECT list(j) AS top FROM (SELECT j FROM m ORDER BY m DESC, j LIMIT 2))
SELECT vec_id, CAST(list_contains(top, list_position(p, list_max(p))) AS INTEGER) AS cluster FROM p, t""")
def _(spark, table):
    # Any responsibilities will do: the softmax of four entries.
    e = embeddings(table).select("vec_id", F.transform(F.slice("v", 1, 4), F.exp).alias("e"))
    p = e.select("vec_id", F.transform("e", lambda x: x / F.aggregate("e", F.lit(0.0), lambda s, y: s + y)).alias("p"))
    return G.top_two_binary(p, "p").select("vec_id", "cluster")


# ---- neighbours and density ---------------------------------------------------------------------------

PAIRS = f"""(SELECT a.vec_id AS u, b.vec_id AS w, list_distance(a.v, b.v) AS d FROM {EMB} a, {EMB} b)"""


@query("nearest_neighbor", f"SELECT u AS key, round(min(d), 6) + 0.0 AS distance FROM {PAIRS} WHERE u <> w GROUP BY u")
def _(spark, table):
    return rounded(N.nearest_neighbors(embeddings(table), "vec_id", "v", 1).select("key", "distance"), "distance")


@query("eps_range", f"""
WITH n AS (SELECT min(d) AS d FROM {PAIRS} WHERE u <> w GROUP BY u),
q AS (SELECT list(d ORDER BY d) AS l, count(*) AS n FROM n),
b AS (SELECT l[CAST(floor(n * 0.1) AS BIGINT) + 1] AS lo, l[CAST(floor(n * 0.9) AS BIGINT) + 1] AS hi FROM q)
SELECT CAST(i AS INTEGER) AS i, round(lo + (hi - lo) * i / 9, 6) + 0.0 AS eps FROM b, range(0, 10) r(i)""")
def _(spark, table):
    eps = DB.eps_from_neighbors(embeddings(table), "vec_id", "v")
    return rounded(spark.createDataFrame(list(enumerate(eps)), "i int, eps double"), "eps")


def _dbscan_sql(eps: float, m: int) -> str:
    return f"""WITH RECURSIVE near AS MATERIALIZED (SELECT u, w FROM {PAIRS} WHERE d <= {eps}),
core AS MATERIALIZED (SELECT u FROM near GROUP BY u HAVING count(*) >= {m}),
edge AS MATERIALIZED (SELECT n.u, n.w FROM near n SEMI JOIN core a ON n.u = a.u SEMI JOIN core b ON n.w = b.u),
reach AS (SELECT u, u AS root FROM core UNION SELECT e.w, r.root FROM reach r JOIN edge e ON r.u = e.u),
root AS MATERIALIZED (SELECT u, min(root) AS root FROM reach GROUP BY u),
number AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS c FROM (SELECT DISTINCT root FROM root)),
border AS (SELECT n.u, min(r.root) AS root FROM near n JOIN root r ON n.w = r.u ANTI JOIN core c ON n.u = c.u GROUP BY n.u),
every AS (SELECT * FROM root UNION ALL SELECT * FROM border)
SELECT vec_id, CAST(coalesce(c, -1) AS INTEGER) AS cluster FROM embeddings LEFT JOIN every ON vec_id = u LEFT JOIN number USING (root)"""


@query("dbscan_labels", _dbscan_sql(1.16, 4))
def _(spark, table):
    return DB.dbscan(embeddings(table), "vec_id", "v", 1.16, 4)


@query("dbscan_tight", _dbscan_sql(1.1, 3))
def _(spark, table):
    return DB.dbscan(embeddings(table), "vec_id", "v", 1.1, 3)


@query("dbscan_search")
def _(spark, table):
    out = SW.dbscan_search(embeddings(table), "vec_id", "v", "label")
    return rounded(out, "eps", "ari", "nmi", "silhouette")


# ---- hierarchy, modes, messages, ensembles ----------------------------------------------------------------

for _l in H.LINKAGES:
    def _agg(linkage):
        @query(f"agglomerative_{linkage}")
        def _(spark, table):
            return H.agglomerative(embeddings(table), "vec_id", "v", 5, linkage).select("vec_id", "cluster")
    _agg(_l)


@query("mean_shift")
def _(spark, table):
    return MS.mean_shift(_z(table, 3), "vec_id", "z")[0].select("vec_id", "cluster")


@query("mean_shift_bandwidth", f"""
SELECT round(sqrt(2 * sum(v)) / 2, 9) + 0.0 AS bandwidth FROM (SELECT var_samp(x) AS v FROM {EMB_LONG} GROUP BY i)""")
def _(spark, table):
    return rounded(spark.createDataFrame([(MS.estimate_bandwidth(embeddings(table), "v"),)], "bandwidth double"), "bandwidth", digits=9)


@query("mean_shift_step", f"""
WITH s AS (SELECT vec_id AS seed, v AS c FROM {EMB} ORDER BY vec_id LIMIT 5),
w AS (SELECT seed, v, exp(-0.5 * (list_distance(v, c) / 0.5) ** 2) AS w FROM {EMB}, s),
l AS (SELECT seed, w, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM w)
SELECT CAST(seed AS INTEGER) AS seed, CAST(i AS INTEGER) AS i, round(sum(w * x) / sum(w), 9) + 0.0 AS x FROM l GROUP BY seed, i""")
def _(spark, table):
    end = MS.shift_seeds(embeddings(table), "v", _first_rows(table, 5), 0.5, 1, 0.0)
    return rounded(spark.createDataFrame([(s, i, float(x)) for s, row in enumerate(end) for i, x in enumerate(row)],
                                         "seed int, i int, x double"), "x", digits=9)


def _affinity_sql(rounds: int, near: int) -> str:
    out = f"""WITH n AS MATERIALIZED (SELECT u AS i, w AS k, -d * d AS s FROM {PAIRS} WHERE u <> w
  QUALIFY row_number() OVER (PARTITION BY u ORDER BY d, w) <= {near}),
p AS (SELECT quantile_cont(s, 0.5) AS p FROM (SELECT s FROM n UNION ALL SELECT 0.0 FROM embeddings)),
e0 AS MATERIALIZED (SELECT i, k, s, 0.0::DOUBLE AS r, 0.0::DOUBLE AS a FROM n UNION ALL SELECT vec_id, vec_id, p, 0.0, 0.0 FROM embeddings, p)"""
    for t in range(rounds):
        out += f""", b{t} AS (SELECT i, arg_max(k, a + s) AS bk, max(a + s, 2) AS top FROM e{t} GROUP BY i),
r{t} AS MATERIALIZED (SELECT i, k, s, a, 0.5 * r + 0.5 * (s - CASE WHEN k = bk THEN top[2] ELSE top[1] END) AS r FROM e{t} JOIN b{t} USING (i)),
c{t} AS (SELECT k, sum(greatest(r, 0)) FILTER (WHERE i <> k) AS p, max(r) FILTER (WHERE i = k) AS rkk FROM r{t} GROUP BY k),
e{t + 1} AS MATERIALIZED (SELECT i, k, s, r, 0.5 * a + 0.5 * CASE WHEN i = k THEN coalesce(p, 0)
  ELSE least(0, rkk + coalesce(p, 0) - greatest(r, 0)) END AS a FROM r{t} JOIN c{t} USING (k))"""
    return out + f" SELECT i AS vec_id, arg_max(k, a + r) AS exemplar FROM e{rounds} GROUP BY i"


@query("affinity_rounds", _affinity_sql(6, 20))
def _(spark, table):
    return AP.affinity_propagation(embeddings(table), "vec_id", "v", 0.5, max_iter=6, neighbors=20).drop("converged")


@query("affinity_propagation")
def _(spark, table):
    return AP.affinity_propagation(_z(table, 3), "vec_id", "z", 0.9, neighbors=10)


TUPLES = "(SELECT vec_id, label, CAST(vec_id % 3 AS INTEGER) AS a, CAST(vec_id % 2 AS INTEGER) AS b, CASE WHEN vec_id % 5 = 0 THEN -1 ELSE CAST(label % 4 AS INTEGER) END AS c FROM embeddings)"


def _tuples(table):
    k = F.col("vec_id")
    return table("embeddings").select("vec_id", "label", (k % 3).cast("int").alias("a"), (k % 2).cast("int").alias("b"),
                                      F.when(k % 5 == 0, -1).otherwise((F.col("label") % 4).cast("int")).alias("c"))


@query("coassociation_signatures", f"SELECT a, b, c, count(*) AS rows, min(vec_id) AS first_key FROM {TUPLES} GROUP BY a, b, c")
def _(spark, table):
    return H.signatures(_tuples(table), "vec_id", ["a", "b", "c"])


@query("coassociation_weights", f"""
WITH g AS (SELECT a, b, c, min(vec_id) AS f FROM {TUPLES} GROUP BY a, b, c)
SELECT x.f AS first_a, y.f AS first_b, round(0.5 * CAST(x.a = y.a AS INTEGER) + 0.2 * CAST(x.b = y.b AS INTEGER)
  + 0.3 * CAST(x.c = y.c AND x.c <> -1 AS INTEGER), 6) + 0.0 AS weight FROM g x, g y""")
def _(spark, table):
    sig = H.signatures(_tuples(table), "vec_id", ["a", "b", "c"]).orderBy("first_key").collect()
    w = H.coassociation(np.array([[r["a"], r["b"], r["c"]] for r in sig]), np.array([0.5, 0.2, 0.3]))
    out = [(p["first_key"], q["first_key"], float(w[i, j])) for i, p in enumerate(sig) for j, q in enumerate(sig)]
    return rounded(spark.createDataFrame(out, "first_a bigint, first_b bigint, weight double"), "weight")


@query("ensemble_clustering")
def _(spark, table):
    return H.ensemble(_tuples(table), "vec_id", ["a", "b", "c"], {"a": 0.5, "b": 0.2, "c": 0.3}, 3, noise_checked=["c"]).select(
        "vec_id", "cluster")


# ---- scoring -------------------------------------------------------------------------------------------------

ARITH = "(SELECT label, CAST((vec_id * 7 + label) % 10 AS INTEGER) AS cluster FROM embeddings)"
BINARY = "(SELECT quality AS label, CAST((doc_id * 5 + toxic) % 3 > 0 AS INTEGER) AS cluster FROM labels)"


def _arith(table):
    return table("embeddings").select("label", ((F.col("vec_id") * 7 + F.col("label")) % 10).cast("int").alias("cluster"))


def _binary(table):
    return table("labels").select(F.col("quality").alias("label"),
                                  ((F.col("doc_id") * 5 + F.col("toxic")) % 3 > 0).cast("int").alias("cluster"))


@query("contingency", f"SELECT label, cluster, count(*) AS rows FROM {ARITH} GROUP BY label, cluster")
def _(spark, table):
    return E.contingency(_arith(table), "label", "cluster")


@query("majority_map", f"""SELECT cluster, label AS mapped FROM (SELECT label, cluster, count(*) AS n FROM {ARITH} GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) = 1""")
def _(spark, table):
    return E.majority_map(E.contingency(_arith(table), "label", "cluster"))


def _agree_sql(src: str, by: str = "") -> str:
    part = f"PARTITION BY {by}, " if by else "PARTITION BY "
    whole = f"OVER (PARTITION BY {by})" if by else "OVER ()"
    key = by + ", " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""WITH c AS (SELECT {key}label, cluster, CAST(count(*) AS DOUBLE) AS r FROM {src} GROUP BY {key}label, cluster),
m AS (SELECT *, sum(r) OVER ({part}label) AS a, sum(r) OVER ({part}cluster) AS b, sum(r) {whole} AS n FROM c),
s AS (SELECT {key}any_value(n) AS n, sum(r * (r - 1) / 2) AS ij, sum((a - 1) / 2 * r) AS ai, sum((b - 1) / 2 * r) AS bj,
  sum(r / n * ln(n * r / (a * b))) AS mi, sum(-r / n * ln(a / n)) AS ha, sum(-r / n * ln(b / n)) AS hb FROM m {group}),
g AS (SELECT {key}(ij - ai * bj / (n * (n - 1) / 2)) / ((ai + bj) / 2 - ai * bj / (n * (n - 1) / 2)) AS ari, mi / ((ha + hb) / 2) AS nmi FROM s)
"""


@query("ari_nmi", _agree_sql(ARITH) + "SELECT round(ari, 9) + 0.0 AS ari, round(nmi, 9) + 0.0 AS nmi FROM g")
def _(spark, table):
    return rounded(E.agreement(E.contingency(_arith(table), "label", "cluster")), "ari", "nmi", digits=9)


def _weighted_sql(src: str) -> str:
    """Majority alignment and support-weighted scores."""
    return f""", mc AS (SELECT label, cluster, CAST(count(*) AS DOUBLE) AS r FROM {src} GROUP BY label, cluster),
mm AS (SELECT cluster, label AS mapped FROM mc QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY r DESC, label) = 1),
f AS (SELECT label, mapped, r FROM mc JOIN mm USING (cluster)),
l AS (SELECT label, sum(r) AS support, sum(r) FILTER (WHERE label = mapped) AS hit FROM f GROUP BY label),
gs AS (SELECT mapped AS label, sum(r) AS guess FROM f GROUP BY mapped),
pr AS (SELECT support, coalesce(hit, 0) AS hit, coalesce(hit / guess, 0) AS p, coalesce(hit / support, 0) AS q FROM l LEFT JOIN gs USING (label)),
fin AS (SELECT sum(hit) / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision, sum(q * support) / sum(support) AS recall,
  sum(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END * support) / sum(support) AS f1 FROM pr)
"""


ROUND6 = ", ".join(f"round({m}, 6) + 0.0 AS {m}" for m in SCORES)


@query("scores_majority", _agree_sql(ARITH) + _weighted_sql(ARITH) + f"SELECT {ROUND6} FROM fin, g")
def _(spark, table):
    return rounded(E.score(_arith(table), "label", "cluster", alignment="majority"), *SCORES)


TWO_BY_TWO = f""", cm AS (SELECT count_if(label = 0 AND cluster = 0) AS t00, count_if(label = 0 AND cluster = 1) AS t01,
  count_if(label = 1 AND cluster = 0) AS t10, count_if(label = 1 AND cluster = 1) AS t11 FROM {BINARY}),
al AS (SELECT CASE WHEN t00 + t11 >= t01 + t10 THEN t11 ELSE t10 END AS tp, CASE WHEN t00 + t11 >= t01 + t10 THEN t01 ELSE t00 END AS fp,
  CASE WHEN t00 + t11 >= t01 + t10 THEN t10 ELSE t11 END AS fn, CASE WHEN t00 + t11 >= t01 + t10 THEN t00 ELSE t01 END AS tn FROM cm),
fin AS (SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM al)
"""


@query("scores_two_classes", _agree_sql(BINARY) + TWO_BY_TWO + f"SELECT {ROUND6} FROM fin, g")
def _(spark, table):
    return rounded(E.score(_binary(table), "label", "cluster"), *SCORES)


@query("majority_flip", f"""
WITH cm AS (SELECT CAST(count_if(label = 0 AND cluster = 0) AS DOUBLE) AS t00, CAST(count_if(label = 0 AND cluster = 1) AS DOUBLE) AS t01,
  CAST(count_if(label = 1 AND cluster = 0) AS DOUBLE) AS t10, CAST(count_if(label = 1 AND cluster = 1) AS DOUBLE) AS t11 FROM {BINARY}),
al AS (SELECT t10 > t11 AS flipped, CASE WHEN t10 > t11 THEN t10 ELSE t11 END AS tp, CASE WHEN t10 > t11 THEN t00 ELSE t01 END AS fp,
  CASE WHEN t10 > t11 THEN t11 ELSE t10 END AS fn, CASE WHEN t10 > t11 THEN t01 ELSE t00 END AS tn FROM cm)
SELECT flipped, round((tp + tn) / (tp + tn + fp + fn), 6) + 0.0 AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) + 0.0 AS precision,
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) + 0.0 AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) + 0.0 AS f1 FROM al""")
def _(spark, table):
    return rounded(E.majority_flip(_binary(table), "label", "cluster"), "accuracy", "precision", "recall", "f1")


@query("sensitivity_specificity", f"""
SELECT l AS label, round(count_if(label = l AND cluster = l) / count_if(label = l), 6) + 0.0 AS sensitivity,
  round(count_if(label <> l AND cluster <> l) / count_if(label <> l), 6) + 0.0 AS specificity
FROM {ARITH}, (SELECT DISTINCT label AS l FROM embeddings) GROUP BY l""")
def _(spark, table):
    cells = E.contingency(_arith(table), "label", "cluster").withColumnRenamed("cluster", "mapped")
    return rounded(E.sensitivity_specificity(cells), "sensitivity", "specificity")


@query("normalised_confusion", f"""
SELECT label, cluster, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY label), 6) + 0.0 AS share
FROM {ARITH} GROUP BY label, cluster""")
def _(spark, table):
    return rounded(E.row_normalised(E.contingency(_arith(table), "label", "cluster")), "share")


@query("silhouette", f"""
WITH p AS (SELECT u, a.label AS lu, b.label AS lw, d * d AS d FROM {PAIRS} JOIN embeddings a ON a.vec_id = u JOIN embeddings b ON b.vec_id = w
  WHERE u <> w),
m AS (SELECT u, lu, lw, avg(d) AS d FROM p GROUP BY ALL),
s AS (SELECT u, min(d) FILTER (WHERE lw = lu) AS a, min(d) FILTER (WHERE lw <> lu) AS b FROM m GROUP BY u)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) + 0.0 AS silhouette FROM s""")
def _(spark, table):
    return rounded(E.silhouette(embeddings(table), "v", "label"), "silhouette")


@query("silhouette_euclidean", f"""
WITH p AS (SELECT u, a.label AS lu, b.label AS lw, d FROM {PAIRS} JOIN embeddings a ON a.vec_id = u JOIN embeddings b ON b.vec_id = w
  WHERE u <> w),
m AS (SELECT u, lu, lw, avg(d) AS d FROM p GROUP BY ALL),
s AS (SELECT u, min(d) FILTER (WHERE lw = lu) AS a, min(d) FILTER (WHERE lw <> lu) AS b FROM m GROUP BY u)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) + 0.0 AS silhouette FROM s""")
def _(spark, table):
    return rounded(E.silhouette_euclidean(embeddings(table), "vec_id", "v", "label"), "silhouette")


# ---- result tables, from runs scored on the tables ------------------------------------------------------------

RUNS = "(SELECT r AS run, label, CAST((vec_id * r + label * (r % 3)) % 10 AS INTEGER) AS cluster FROM embeddings, range(1, 9) t(r))"


def _runs(table):
    df = table("embeddings").select("vec_id", "label", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("run"))
    return df.select("run", "label", ((F.col("vec_id") * F.col("run") + F.col("label") * (F.col("run") % 3)) % 10).cast("int").alias("cluster"))


def _run_scores(table):
    return E.agreement(E.contingency(_runs(table), "label", "cluster", ["run"]), ["run"])


RUN_SQL = _agree_sql(RUNS, "run")


@query("best_by_metric", RUN_SQL + "SELECT CAST(run AS INTEGER) AS run, round(ari, 9) + 0.0 AS ari, round(nmi, 9) + 0.0 AS nmi FROM g ORDER BY g.ari DESC, run LIMIT 1")
def _(spark, table):
    return rounded(E.best_by(_run_scores(table), "ari", "run"), "ari", "nmi", digits=9)


@query("rank_results", RUN_SQL + """SELECT CAST(run AS INTEGER) AS run, round(ari, 9) + 0.0 AS ari, round(nmi, 9) + 0.0 AS nmi,
  CAST(row_number() OVER (ORDER BY round(g.nmi, 9) DESC, run) - 1 AS INTEGER) AS position FROM g""")
def _(spark, table):
    return E.rank_results(rounded(_run_scores(table), "ari", "nmi", digits=9), "nmi", ["run"])


@query("pivot_best", RUN_SQL + """SELECT CAST(run % 2 AS INTEGER) AS clustering, round(max(nmi) FILTER (WHERE run % 3 = 0), 9) + 0.0 AS "0",
  round(max(nmi) FILTER (WHERE run % 3 = 1), 9) + 0.0 AS "1", round(max(nmi) FILTER (WHERE run % 3 = 2), 9) + 0.0 AS "2" FROM g GROUP BY run % 2""")
def _(spark, table):
    s = _run_scores(table).select((F.col("run") % 2).alias("clustering"), (F.col("run") % 3).alias("reduction"), "nmi")
    return rounded(E.pivot_best(s, "clustering", "reduction", [0, 1, 2], "nmi"), "0", "1", "2", digits=9)


@query("win_counts", RUN_SQL + """, w AS (SELECT a.run, round(a.nmi, 9) AS gmm, round(b.nmi, 9) AS kmeans FROM g a JOIN g b ON b.run = a.run + 4)
SELECT count_if(gmm > kmeans) AS gmm_wins, count_if(kmeans > gmm) AS kmeans_wins, count_if(gmm = kmeans) AS ties FROM w""")
def _(spark, table):
    s = rounded(_run_scores(table), "nmi", digits=9)
    a, b = s.where("run <= 4").select("run", F.col("nmi").alias("gmm")), s.where("run > 4").select(
        (F.col("run") - 4).alias("run"), F.col("nmi").alias("kmeans"))
    return E.win_counts(a.join(b, "run"), "gmm", "kmeans")


INERTIA = f"""WITH e AS (SELECT vec_id, v, row_number() OVER (ORDER BY vec_id) AS o FROM {EMB}),
d AS (SELECT a.vec_id, c.o, list_sum(list_transform(list_zip(a.v, c.v), lambda p: (p[1] - p[2]) ** 2)) AS d FROM e a JOIN e c ON c.o <= 8),
n AS (SELECT k, vec_id, min(d) AS d FROM d JOIN range(2, 9) t(k) ON o <= k GROUP BY ALL),
s AS (SELECT k, sum(d) AS score FROM n GROUP BY k)"""


def _start_inertia(table):
    df, c = embeddings(table), _first_rows(table, 8)
    out = None
    for k in range(2, 9):
        part = K.inertia_by_cluster(df, "v", c[:k]).agg(F.sum("inertia").alias("score")).select(F.lit(k).alias("k"), "score")
        out = part if out is None else out.unionByName(part)
    return out


@query("inertia_by_k", INERTIA + "SELECT CAST(k AS INTEGER) AS k, round(score, 6) + 0.0 AS score FROM s")
def _(spark, table):
    return rounded(_start_inertia(table), "score")


@query("elbow_k", INERTIA + """, w AS (SELECT k, lead(score) OVER (ORDER BY k) - 2 * score + lag(score) OVER (ORDER BY k) AS second FROM s)
SELECT CAST(k AS INTEGER) AS k FROM w WHERE second IS NOT NULL ORDER BY second, k LIMIT 1""")
def _(spark, table):
    return E.elbow(_start_inertia(table), "k", "score")


# ---- sweeps ------------------------------------------------------------------------------------------------------

@query("whitened_kmeans")
def _(spark, table):
    return rounded(SW.whitened_kmeans(embeddings(table), "vec_id", "v", "label", 20, 10, 5)[1], *SCORES)


@query("component_sweep")
def _(spark, table):
    return rounded(SW.component_sweep(embeddings(table), "vec_id", "v", "label", 10, range(1, 31)), *SCORES)


@query("whitening_sweep")
def _(spark, table):
    return rounded(SW.component_sweep(embeddings(table), "vec_id", "v", "label", 10, range(1, 31), "hybrid"), *SCORES)


@query("graph_sweep")
def _(spark, table):
    return rounded(SW.component_sweep(embeddings(table), "vec_id", "v", "label", 10, range(1, 11), "graph", threshold=0.1), *SCORES)


@query("optimal_k_silhouette")
def _(spark, table):
    return rounded(SW.optimal_k(_z(table, 5), "vec_id", "z", 8)[1], "score")


@query("optimal_k_elbow")
def _(spark, table):
    return rounded(SW.optimal_k(_z(table, 5), "vec_id", "z", 8, "elbow")[1], "score")


@query("reduction_grid")
def _(spark, table):
    return rounded(SW.reduction_grid(embeddings(table), "vec_id", "v", 10), "silhouette")


@query("kmeans_variants")
def _(spark, table):
    return rounded(SW.kmeans_variants(_z(table), "vec_id", "z", "label", 2)[0], *SCORES)


@query("kmeans_against_gmm")
def _(spark, table):
    return rounded(SW.kmeans_against_gmm(_z(table, 5), "vec_id", "z", "label", 3), *SCORES)


@query("gmm_with_binary")
def _(spark, table):
    return rounded(SW.gmm_with_binary(_z(table, 2), "vec_id", "z", "label", 4), *SCORES)


@query("many_algorithms")
def _(spark, table):
    out = SW.many_algorithms(_z(table, 3), "vec_id", "z", "label", 3, 0.5, 5, neighbors=10, max_iter=200)[1]
    return rounded(out, *SCORES).drop("seconds")


@query("ensemble_selection")
def _(spark, table):
    out = SW.ensemble_selection(_z(table, 3), "vec_id", "z", "label", 4, max_iter=200)[1]
    return rounded(out, *SCORES).drop("seconds")


@query("reduction_by_clustering")
def _(spark, table):
    return rounded(SW.reduction_by_clustering(embeddings(table), "vec_id", "v", "label", 5, 3, max_iter=200), *SCORES)


@query("approach_comparison")
def _(spark, table):
    out = SW.approach_comparison(embeddings(table), "vec_id", "v", "label", tuple(SW.APPROACHES), 5, 2)
    return rounded(out, *SCORES)


@query("prepare_select_reduce")
def _(spark, table):
    cols = [f"f{i}" for i in range(64)]
    df = embeddings(table).select("vec_id", "label", *[F.col("v")[i].alias(c) for i, c in enumerate(cols)])
    out, (_, k) = SW.prepare_select_reduce(df, cols, "vec_id", "label", 10)
    return out.select("vec_id", "label", rnd(F.col("z")[0]).alias("c0"), rnd(F.col("z")[1]).alias("c1"))


@query("evaluate_combined")
def _(spark, table):
    df = embeddings(table)
    return rounded(SW.evaluate_combined(df, "vec_id", "v", "label", 10, 2, 10, [(i, i + 32) for i in range(32)]), *SCORES)
