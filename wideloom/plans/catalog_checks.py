"""Queries that run one operator from given parameters, so that SQL can repeat it in full."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from wideloom.operators import features as FT
from wideloom.operators import hierarchy as H
from wideloom.operators import prep
from wideloom.operators import reduce as R
from wideloom.plans import steps as ST
from wideloom.plans.registry import EMB_LONG, embeddings, query, rnd, rounded

WIDTH = 64  # of the embeddings


def _matrix_sql(m: np.ndarray) -> str:
    """(i, m0, m1, ...) rows of a matrix."""
    rows = ", ".join(f"({i}, {', '.join(repr(float(x)) for x in row)})" for i, row in enumerate(m))
    return f"(VALUES {rows}) AS m(i, {', '.join(f'm{j}' for j in range(m.shape[1]))})"


def _entries(df, vec, k, digits=9):
    return df.select("vec_id", *[rnd(F.col(vec)[j], digits).alias(f"c{j}") for j in range(k)])


def _drawn(k: int) -> np.ndarray:
    return np.random.default_rng(42).normal(0.0, 1.0 / np.sqrt(k), size=(WIDTH, k))


def _projected(x: str, source: str) -> str:
    return (f"SELECT vec_id, {', '.join(f'round(sum({x} * m{j}), 7) + 0.0 AS c{j}' for j in range(4))} "
            f"FROM {source} JOIN {_matrix_sql(_drawn(4))} USING (i) GROUP BY vec_id")


@query("random_projection_rows", _projected("x", EMB_LONG))
def _(spark, table):
    df = embeddings(table)
    return _entries(R.random_projection(df, "v", 4).transform(df, "v", "z"), "z", 4, 7)


@query("step_chain_projection", f"""
WITH s AS (SELECT vec_id, i, (x - avg(x) OVER (PARTITION BY i)) / stddev_pop(x) OVER (PARTITION BY i) AS x FROM {EMB_LONG})
{_projected("x", "s")}""")
def _(spark, table):
    chain = [{"name": "scaling", "type": "standard"}, {"name": "select_variance", "threshold": 0.5},
             {"name": "random_projection", "n_components": 4}]
    return _entries(ST.run_steps(embeddings(table), "vec_id", "v", chain), "v", 4, 7)


@query("pooled_features", "SELECT vec_id, " + ", ".join(
    f"round(avg(x) FILTER (WHERE i % 8 = {j}), 9) + 0.0 AS c{j}" for j in range(8)) + f" FROM {EMB_LONG} GROUP BY vec_id")
def _(spark, table):
    return _entries(H.FeatureAgglomeration(np.arange(WIDTH) % 8).transform(embeddings(table), "v", "z"), "z", 8)


@query("select_by_importance", f"""
WITH v AS (SELECT i, var_pop(x) AS v FROM {EMB_LONG} GROUP BY i)
SELECT CAST(i AS INTEGER) AS feature FROM v WHERE v >= (SELECT avg(v) FROM v)""")
def _(spark, table):
    chosen = FT.select_from_model(R.gram_diagonal(embeddings(table), "v")[1], "mean")
    return spark.createDataFrame([(int(i),) for i in chosen], "feature int")


@query("polynomial_variance", f"""
WITH e AS {EMB_LONG}, t AS (SELECT i AS a, -1 AS b, x FROM e UNION ALL
  SELECT p.i, q.i, p.x * q.x FROM e p JOIN e q ON p.vec_id = q.vec_id AND p.i <= q.i)
SELECT CAST(count(*) AS BIGINT) AS terms, round(sum(v), 8) + 0.0 AS total FROM (SELECT a, b, var_samp(x) AS v FROM t GROUP BY a, b)""")
def _(spark, table):
    m = R.polynomial_pca(embeddings(table), "v", 10)
    total = float(m.explained[0] / m.ratio[0])
    return rounded(spark.createDataFrame([(m.matrix.shape[0], total)], "terms bigint, total double"), "total", digits=8)


LEVELS = "((i % 5 + 1) / 10.0)"


@query("nmf_update", f"""
WITH e AS (SELECT vec_id, i, greatest(x, 0) AS x, CAST({LEVELS} AS DOUBLE) AS h FROM {EMB_LONG}),
w AS (SELECT vec_id, sum(x * h) / sum(h * h) AS w FROM e GROUP BY vec_id)
SELECT CAST(i AS INTEGER) AS i, round(sum(w * x) / sum(w * w), 9) + 0.0 AS h FROM e JOIN w USING (vec_id) GROUP BY i""")
def _(spark, table):
    start = ((np.arange(WIDTH) % 5 + 1) / 10.0)[None, :]
    h = R.nmf(embeddings(table), "v", 1, max_iter=1, init=start).components[0]
    return rounded(spark.createDataFrame([(i, float(x)) for i, x in enumerate(h)], "i int, h double"), "h", digits=9)


@query("dictionary_update", f"""
WITH e AS (SELECT vec_id, i, x - least(0, min(x) OVER ()) AS x FROM {EMB_LONG}),
r AS (SELECT vec_id, sum(x / 8) AS r FROM e GROUP BY vec_id),
c AS (SELECT vec_id, sign(r) * greatest(abs(r) - 0.25, 0) AS a FROM r),
u AS (SELECT i, sum(a * x) / sum(a * a) AS d FROM e JOIN c USING (vec_id) GROUP BY i)
SELECT CAST(i AS INTEGER) AS i, round(d / greatest(1, sqrt(sum(d * d) OVER ())), 9) + 0.0 AS d FROM u""")
def _(spark, table):
    start = np.full((1, WIDTH), 1 / 8)
    d = R.dictionary_learning(embeddings(table), "v", 1, 0.25, max_iter=1, init=start).components[0]
    return rounded(spark.createDataFrame([(i, float(x)) for i, x in enumerate(d)], "i int, d double"), "d", digits=9)


PLAIN = ("l_quantity", "l_discount", "l_tax")


@query("adaptive_preprocess_plain", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, nullif(l_tax, 0.0) AS l_tax FROM lineitem),
f AS (SELECT * REPLACE (coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM t)) AS l_tax) FROM t)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, """ + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) + 0.0 AS {c}" for c in PLAIN) + " FROM f")
def _(spark, table):
    df = table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
                                  F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return rounded(prep.adaptive_preprocess(df, list(PLAIN))[0], *PLAIN)
