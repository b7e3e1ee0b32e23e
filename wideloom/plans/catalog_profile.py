"""Queries: sources, samples, profiling, scaling and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from wideloom.functions import stats as S
from wideloom.operators import prep, profile
from wideloom.plans.registry import EMB, EMB_LONG, LI, embeddings, long_sql, poly_sql, query, rnd, rounded
from wideloom.session import scratch_path
from wideloom.sources import tables as T

LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LI_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


# ---- sources and samples ---------------------------------------------------------------

@query("csv_load", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(spark, table):
    src = table("customer")
    path = scratch_path(spark, "customer-csv")
    T.save_table(src, path, "csv")
    return T.load_table(spark, path, src.schema)


@query("csv_save", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, table):
    return T.save_table(table("nation"), scratch_path(spark, "nation-csv"), "csv")


@query("labelled_matrix", f"""
SELECT {LI_ID}, {', '.join(LI)},
  CAST(CASE l_linestatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS INTEGER) AS label FROM lineitem""")
def _(spark, table):
    return T.labelled_table(table("lineitem"), "l_linestatus", {"F": 0, "O": 1}, T.FeatureSpec(), LI_KEYS)


@query("label_distribution", """
SELECT label, count(*) AS rows, round(100.0 * count(*) / sum(count(*)) OVER (), 6) + 0.0 AS percent
FROM embeddings GROUP BY label""")
def _(spark, table):
    return rounded(T.label_distribution(table("embeddings"), "label"), "percent")


@query("coerced_mean_fill", """
WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus,
  TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE) AS l_quantity,
  nullif(l_tax, 0.0) AS l_tax FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linestatus,
  round(coalesce(l_quantity, (SELECT avg(l_quantity) FROM t)), 6) + 0.0 AS l_quantity,
  round(coalesce(l_tax, (SELECT avg(l_tax) FROM t)), 6) + 0.0 AS l_tax FROM t""")
def _(spark, table):
    df = table("lineitem").select(
        *LI_KEYS, "l_linestatus", "l_shipdate",
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("l_quantity"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"))
    return rounded(T.coerced_table(df, "l_linestatus", ["l_shipdate"], LI_KEYS), "l_quantity", "l_tax")


@query("prefix_features", "SELECT c_mktsegment, c_custkey, c_nationkey, c_acctbal FROM customer")
def _(spark, table):
    df = table("customer")
    return df.select("c_mktsegment", *T.FeatureSpec(prefix="c_").resolve(df.schema))


@query("label_encode", """
SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code
FROM orders""")
def _(spark, table):
    return T.encode_labels(table("orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority").select(
        "o_orderkey", "o_orderpriority", "code")


@query("fixed_sample", """
SELECT vec_id, label FROM embeddings ORDER BY md5(concat_ws('|', CAST(vec_id AS VARCHAR), '42')), vec_id LIMIT 100""")
def _(spark, table):
    return T.fixed_sample(table("embeddings").select("vec_id", "label"), ["vec_id"], 100)


@query("fraction_sample", """
SELECT event_id, event_type, value FROM events
WHERE ((((event_id % 1000000007) * 48271 + 12345) % 2147483647) * 69621 + 7) % 2147483647 < 0.1 * 2147483647""")
def _(spark, table):
    return T.fraction_sample(table("events").select("event_id", "event_type", "value"), "event_id", 0.1)


@query("stratified_split", """
SELECT event_id, event_type, CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR)))
  <= floor(0.7 * count(*) OVER (PARTITION BY event_type) + 0.5) THEN 'train' ELSE 'test' END AS split FROM events""")
def _(spark, table):
    return T.stratified_split(table("events").select("event_id", "event_type"), "event_id", "event_type", None)


@query("reuse_processed", """
SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 6) + 0.0 AS c_acctbal
FROM customer""")
def _(spark, table):
    df = table("customer").select("c_custkey", "c_acctbal")
    path = scratch_path(spark, "customer-scaled")
    build = lambda: prep.scale(df, ["c_acctbal"]).transform(df)
    T.reuse_or_build(spark, path, build, force=True)
    return rounded(T.reuse_or_build(spark, path, build), "c_acctbal")


# ---- profiling ----------------------------------------------------------------------------

@query("distinct_values", """
SELECT DISTINCT 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem UNION
SELECT DISTINCT 'l_linestatus', l_linestatus FROM lineitem""")
def _(spark, table):
    return profile.distinct_values(table("lineitem"), ["l_returnflag", "l_linestatus"])


@query("missing_counts", """
SELECT * FROM (SELECT 'l_tax' AS "column", count_if(nullif(l_tax, 0.0) IS NULL) AS missing FROM lineitem UNION ALL
SELECT 'l_discount', count_if(nullif(l_discount, 0.0) IS NULL) FROM lineitem UNION ALL
SELECT 'l_quantity', count_if(l_quantity IS NULL) FROM lineitem) WHERE missing > 0""")
def _(spark, table):
    df = table("lineitem").select("l_quantity", *[F.nullif(c, F.lit(0.0)).alias(c) for c in ("l_tax", "l_discount")])
    return profile.missing_counts(df, df.columns)


DESCRIBE = """SELECT feature, count(value) AS count, round(avg(value), 6) + 0.0 AS mean,
  round(stddev_samp(value), 6) + 0.0 AS std, min(value) AS min, max(value) AS max,
  round(skewness(value), 6) + 0.0 AS skewness, round(kurtosis(value), 6) + 0.0 AS kurtosis
FROM {} GROUP BY feature"""


@query("describe_moments", DESCRIBE.format(long_sql("lineitem", LI)))
def _(spark, table):
    return rounded(profile.describe(table("lineitem"), LI), "mean", "std", "skewness", "kurtosis")


@query("describe_events", DESCRIBE.format(long_sql("events", ["value"])))
def _(spark, table):
    return rounded(profile.describe(table("events"), ["value"]), "mean", "std", "skewness", "kurtosis")


MIXED = "(SELECT event_id % 7 AS a, value AS b, sqrt(value) AS c FROM events)"


def _mixed(table):
    return table("events").select((F.col("event_id") % 7).cast("double").alias("a"), F.col("value").alias("b"),
                                  F.sqrt("value").alias("c"))


@query("skew_buckets", f"""
SELECT feature, round(skewness(value), 6) + 0.0 AS skewness, CASE WHEN abs(skewness(value)) > 1 THEN 'high'
  WHEN abs(skewness(value)) > 0.5 THEN 'moderate' ELSE 'low' END AS bucket
FROM {long_sql(MIXED, ['a', 'b', 'c'])} GROUP BY feature""")
def _(spark, table):
    return rounded(profile.skew_buckets(_mixed(table), ["a", "b", "c"]), "skewness")


@query("jarque_bera", f"""
WITH m AS (SELECT feature, avg(value) AS mu, count(*) AS n FROM {long_sql("lineitem", LI)} GROUP BY feature),
c AS (SELECT feature, any_value(n) AS n, avg((value - mu) ** 2) AS m2, avg((value - mu) ** 3) AS m3,
  avg((value - mu) ** 4) AS m4 FROM {long_sql("lineitem", LI)} JOIN m USING (feature) GROUP BY feature),
j AS (SELECT feature, n, n / 6.0 * (m3 * m3 / m2 ** 3 + (m4 / (m2 * m2) - 3) ** 2 / 4.0) AS jb FROM c)
SELECT feature, n AS count, round(jb, 4) + 0.0 AS jb, round(exp(-jb / 2), 6) + 0.0 AS p_value, exp(-jb / 2) < 0.05 AS rejected
FROM j""")
def _(spark, table):
    out = profile.jarque_bera(table("lineitem"), LI)
    return rounded(rounded(out, "p_value"), "jb", digits=4)


def _quantile_sql(p: str) -> str:
    """AS 241 in SQL for a column reference."""
    q, r = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1.0 - {p})))"
    s = f"(0.180625 - {q} * {q})"
    mid = f"{q} * {poly_sql(s, S.QUANTILE_MID[0])} / {poly_sql(s, S.QUANTILE_MID[1])}"
    t, f = f"({r} - 1.6)", f"({r} - 5.0)"
    tail = f"{poly_sql(t, S.QUANTILE_TAIL[0])} / {poly_sql(t, S.QUANTILE_TAIL[1])}"
    far = f"{poly_sql(f, S.QUANTILE_FAR[0])} / {poly_sql(f, S.QUANTILE_FAR[1])}"
    return (f"CASE WHEN abs({q}) <= 0.425 THEN {mid} ELSE (CASE WHEN {q} < 0 THEN -1 ELSE 1 END) * "
            f"(CASE WHEN {r} <= 5 THEN {tail} ELSE {far} END) END")


def _upper_sql(z: str) -> str:
    """P(N(0,1) > z) in SQL for a column reference (|z| < 7)."""
    x = f"abs({z})"
    t = f"exp(-{x} * {x} / 2) * {poly_sql(x, S.TAIL_NUM[::-1])} / {poly_sql(x, S.TAIL_DEN[::-1])}"
    return f"CASE WHEN {z} >= 0 THEN {t} ELSE 1 - {t} END"




@query("shapiro_wilk", f"""
WITH s AS (SELECT value FROM events),
x AS (SELECT value, CAST(row_number() OVER (ORDER BY value) AS DOUBLE) AS i, CAST(count(*) OVER () AS DOUBLE) AS n FROM s),
p AS (SELECT *, (i - 0.375) / (n + 0.25) AS p FROM x), m AS (SELECT *, {_quantile_sql('p')} AS m FROM p),
u AS (SELECT any_value(n) AS n, sum(m * m) AS mm, max(m) AS m1, max(m) FILTER (WHERE i = n - 1) AS m2, avg(value) AS mu,
  1 / sqrt(any_value(n)) AS rsn FROM m),
a AS (SELECT *, {poly_sql('rsn', profile.ROYSTON_LAST)} + m1 / sqrt(mm) AS a1,
  {poly_sql('rsn', profile.ROYSTON_SECOND)} + m2 / sqrt(mm) AS a2 FROM u),
f AS (SELECT *, sqrt((mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS fac FROM a),
w AS (SELECT any_value(f.n) AS n, pow(sum((CASE WHEN m.i = 1 THEN -a1 WHEN m.i = f.n THEN a1 WHEN m.i = 2 THEN -a2
  WHEN m.i = f.n - 1 THEN a2 ELSE m.m / fac END) * (value - mu)), 2) / sum((value - mu) ** 2) AS w FROM m, f),
z AS (SELECT n, w, (ln(1 - w) - {poly_sql('ln(n)', profile.ROYSTON_MEAN)}) / exp({poly_sql('ln(n)', profile.ROYSTON_SD)}) AS z
  FROM w)
SELECT 'value' AS feature, CAST(n AS BIGINT) AS count, round(w, 6) + 0.0 AS w,
  CASE WHEN n <= 5000 THEN round({_upper_sql('z')}, 9) + 0.0 END AS p_value, CASE WHEN n <= 5000 THEN {_upper_sql('z')} < 0.05 END AS rejected
FROM z""")
def _(spark, table):
    out = profile.shapiro_wilk(table("events"), ["value"])
    return rounded(rounded(out, "w"), "p_value", digits=9)


@query("group_sizes", "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type")
def _(spark, table):
    return profile.group_sizes(table("events"), "event_type")


@query("mann_whitney", f"""
WITH r AS (SELECT feature, l_linestatus AS g, rank() OVER (PARTITION BY feature ORDER BY value)
  + (count(*) OVER (PARTITION BY feature, value) - 1) / 2.0 AS mid, count(*) OVER (PARTITION BY feature, value) AS t
  FROM {long_sql("lineitem", LI, "l_linestatus")}),
s AS (SELECT feature, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(g = 'F') AS DOUBLE) AS n1,
  sum(mid) FILTER (WHERE g = 'F') AS rs, sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM r GROUP BY feature),
u AS (SELECT *, n - n1 AS n2, rs - n1 * (n1 + 1) / 2 AS u FROM s),
z AS (SELECT *, (greatest(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS z
  FROM u), p AS (SELECT *, least(1.0, 2 * ({_upper_sql('z')})) AS p FROM z)
SELECT feature, CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, round(u, 1) + 0.0 AS u, round(z, 6) + 0.0 AS z,
  round(p, 6) + 0.0 AS p_value, p < 0.05 AS significant FROM p""")
def _(spark, table):
    out = profile.mann_whitney(table("lineitem"), LI, "l_linestatus", "F", "O")
    return rounded(rounded(out, "z", "p_value"), "u", digits=1)


CORR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS value FROM lineitem"
                          for i, a in enumerate(LI) for b in LI[i + 1:])


@query("corr_matrix", CORR)
def _(spark, table):
    return rounded(profile.correlations(table("lineitem"), LI), "value")


@query("corr_constant_column", """
SELECT 'l_quantity' AS a, 'one' AS b, CAST(NULL AS DOUBLE) AS value UNION ALL SELECT 'one', 'tax', NULL UNION ALL
SELECT 'l_quantity', 'tax', round(corr(l_quantity, nullif(l_tax, 0.0)), 6) + 0.0 FROM lineitem""")
def _(spark, table):
    df = table("lineitem").select("l_quantity", F.lit(1.5).alias("one"), F.nullif("l_tax", F.lit(0.0)).alias("tax"))
    return rounded(profile.correlations(df, df.columns), "value")


@query("cov_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 4) + 0.0 AS value FROM lineitem"
    for i, a in enumerate(LI) for b in LI[i:]))
def _(spark, table):
    return rounded(profile.correlations(table("lineitem"), LI, "cov"), "value", digits=4)


TOP_PAIRS = f"""
SELECT 'f' || a.i AS a, 'f' || b.i AS b, round(corr(a.x, b.x), 6) + 0.0 AS value FROM {EMB_LONG} a JOIN {EMB_LONG} b
  ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i ORDER BY abs(corr(a.x, b.x)) DESC, a, b LIMIT 10"""


@query("top_corr_pairs", TOP_PAIRS)
@query("top_corr_pairs_all", TOP_PAIRS)
def _(spark, table):
    names = [f"f{i}" for i in range(64)]
    df = embeddings(table).select(*[F.col("v")[i].alias(n) for i, n in enumerate(names)])
    return rounded(profile.top_correlated_pairs(df, names), "value")


@query("iqr_outliers", f"""
WITH q AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM {long_sql(MIXED, ['a', 'b', 'c'])} GROUP BY feature),
b AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT feature, round(any_value(q1), 6) + 0.0 AS q1, round(any_value(q3), 6) + 0.0 AS q3, round(any_value(lo), 6) + 0.0 AS lower,
  round(any_value(hi), 6) + 0.0 AS upper, count_if(value < lo OR value > hi) AS outliers
FROM {long_sql(MIXED, ['a', 'b', 'c'])} JOIN b USING (feature) GROUP BY feature""")
def _(spark, table):
    return rounded(profile.iqr_outliers(_mixed(table), ["a", "b", "c"]), "q1", "q3", "lower", "upper")


@query("preprocessing_advice_wide", f"""
WITH t AS (SELECT event_id % 4 * 1.0 + 10 AS flat, {', '.join(f'CAST(event_id % {i + 3} AS DOUBLE) AS p{i}' for i in range(23))},
  CASE WHEN event_id % 500 = 0 THEN 1000000.0 ELSE CAST(event_id % 9 AS DOUBLE) END AS p23 FROM events),
l AS (UNPIVOT t ON COLUMNS(*) INTO NAME feature VALUE value),
s AS (SELECT feature, skewness(value) AS s, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY feature),
o AS (SELECT count(*) > 0 AS has FROM l JOIN s USING (feature) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE abs(s) > 1), '') AS highly_skewed,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE abs(s) > 0.5 AND abs(s) <= 1), '') AS moderately_skewed,
  any_value(has) AS has_outliers, CASE WHEN any_value(has) THEN 'robust' ELSE 'standard' END AS scaler FROM s, o""")
def _(spark, table):
    k = F.col("event_id")
    df = table("events").select((k % 4 * 1.0 + 10).alias("flat"), *[(k % (i + 3)).cast("double").alias(f"p{i}") for i in range(23)],
                                F.when(k % 500 == 0, 1000000.0).otherwise((k % 9).cast("double")).alias("p23"))
    return profile.preprocessing_advice(df, df.columns)


@query("preprocessing_advice", f"""
WITH s AS (SELECT feature, skewness(value) AS s, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM {long_sql(MIXED, ['a', 'b', 'c'])} GROUP BY feature),
o AS (SELECT count(*) > 0 AS has FROM {long_sql(MIXED, ['a', 'b', 'c'])} JOIN s USING (feature)
  WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE abs(s) > 1), '') AS highly_skewed,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE abs(s) > 0.5 AND abs(s) <= 1), '') AS moderately_skewed,
  any_value(has) AS has_outliers, CASE WHEN any_value(has) THEN 'robust' ELSE 'standard' END AS scaler FROM s, o""")
def _(spark, table):
    return profile.preprocessing_advice(_mixed(table), ["a", "b", "c"])


# ---- outliers -------------------------------------------------------------------------------

EV = "(SELECT event_id, value, sqrt(value) AS root FROM events)"
EVZ = f"""SELECT event_id, value, root, abs((value - avg(value) OVER ()) / stddev_pop(value) OVER ()) > {{t}}
  OR abs((root - avg(root) OVER ()) / stddev_pop(root) OVER ()) > {{t}} AS is_outlier FROM {EV}"""


def _ev(table):
    return table("events").select("event_id", "value", F.sqrt("value").alias("root"))


@query("zscore_outliers", f"SELECT event_id, is_outlier FROM ({EVZ.format(t=3)})")
def _(spark, table):
    return prep.outlier_mask(_ev(table), ["value", "root"]).select("event_id", "is_outlier")


@query("outliers_flagged", f"SELECT event_id, value, round(root, 6) + 0.0 AS root, is_outlier FROM ({EVZ.format(t=3)})")
def _(spark, table):
    return rounded(prep.handle_outliers(_ev(table), ["value", "root"], "none"), "root")


@query("outliers_removed", f"""
SELECT event_id, value, round(root, 6) + 0.0 AS root, is_outlier FROM ({EVZ.format(t=3)})
QUALIFY NOT is_outlier OR count_if(is_outlier) OVER () >= 0.3 * count(*) OVER ()""")
def _(spark, table):
    return rounded(prep.handle_outliers(_ev(table), ["value", "root"], "remove"), "root")


@query("outliers_winsorized", f"""
SELECT event_id, is_outlier,
  round(least(greatest(value, avg(value) OVER () - 3 * stddev_pop(value) OVER ()),
    avg(value) OVER () + 3 * stddev_pop(value) OVER ()), 6) + 0.0 AS value,
  round(least(greatest(root, avg(root) OVER () - 3 * stddev_pop(root) OVER ()),
    avg(root) OVER () + 3 * stddev_pop(root) OVER ()), 6) + 0.0 AS root
FROM ({EVZ.format(t=3)})""")
def _(spark, table):
    return rounded(prep.handle_outliers(_ev(table), ["value", "root"], "winsorize"), "value", "root")


@query("outlier_policy_removed", f"""
SELECT event_id, value, round(root, 6) + 0.0 AS root, 'removed' AS policy FROM ({EVZ.format(t=3)})
QUALIFY NOT is_outlier AND count_if(is_outlier) OVER () < 0.3 * count(*) OVER ()""")
def _(spark, table):
    return rounded(prep.remove_or_rescale(_ev(table), ["value", "root"], 3.0), "root")


@query("outlier_policy_robust", f"""
WITH q AS (SELECT quantile_cont(value, 0.5) AS m, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS w,
  quantile_cont(root, 0.5) AS rm, quantile_cont(root, 0.75) - quantile_cont(root, 0.25) AS rw FROM {EV})
SELECT event_id, round((value - m) / w, 6) + 0.0 AS value, round((root - rm) / rw, 6) + 0.0 AS root, 'robust' AS policy
FROM ({EVZ.format(t=0.5)}), q QUALIFY count_if(is_outlier) OVER () >= 0.3 * count(*) OVER ()""")
def _(spark, table):
    return rounded(prep.remove_or_rescale(_ev(table), ["value", "root"], 0.5), "value", "root")


# ---- data behind figures ---------------------------------------------------------------------

EMB_Z2 = f"""(SELECT vec_id, label, (v[1] - avg(v[1]) OVER ()) / stddev_pop(v[1]) OVER () AS x,
  (v[2] - avg(v[2]) OVER ()) / stddev_pop(v[2]) OVER () AS y FROM {EMB})"""


def _z2(table):
    df = embeddings(table).select("vec_id", "label", F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))
    return prep.scale(df, ["x", "y"]).transform(df)


@query("zoom_regions", " UNION ALL ".join(
    f"SELECT '{n}' AS region, vec_id, label FROM {EMB_Z2} WHERE x > {a} AND x < {b} AND y > {a} AND y < {b}"
    for n, a, b in (("center", -3, 3), ("dense", -1, 1), ("outlier", 0.5, 7))))
def _(spark, table):
    z = _z2(table)
    out = None
    for n, a, b in (("center", -3, 3), ("dense", -1, 1), ("outlier", 0.5, 7)):
        part = profile.region(z, F.col("x"), F.col("y"), a, b).select(F.lit(n).alias("region"), "vec_id", "label")
        out = part if out is None else out.unionByName(part)
    return out


@query("histogram", """
WITH r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 20 AS w FROM events),
b AS (SELECT CAST(least(floor((value - lo) / w), 19) AS INTEGER) AS bin, lo, w FROM events, r)
SELECT bin, round(any_value(lo) + bin * any_value(w), 6) + 0.0 AS left_edge,
  round(any_value(lo) + (bin + 1) * any_value(w), 6) + 0.0 AS right_edge, count(*) AS rows FROM b GROUP BY bin""")
def _(spark, table):
    return rounded(profile.histogram(table("events"), "value", 20), "left_edge", "right_edge")


@query("qq_points", f"""
WITH r AS (SELECT value, count(*) AS rows, rank() OVER (ORDER BY value) AS o FROM events GROUP BY value),
c AS (SELECT value, rows, coalesce(sum(rows) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  + (rows + 1) / 2.0 AS mid, sum(rows) OVER () AS n FROM r),
p AS (SELECT *, CASE WHEN mid = 1 THEN 1 - pow(0.5, 1.0 / n) WHEN mid = n THEN pow(0.5, 1.0 / n)
  ELSE (mid - 0.3175) / (n + 0.365) END AS p FROM c)
SELECT value, rows, round(mid, 1) + 0.0 AS mid_rank, round({_quantile_sql('p')}, 6) + 0.0 AS theoretical FROM p""")
def _(spark, table):
    return rounded(rounded(profile.qq_points(table("events"), "value"), "theoretical"), "mid_rank", digits=1)


@query("box_stats", """
WITH q AS (SELECT event_type AS grp, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS m,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY event_type),
j AS (SELECT q.*, value, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM events JOIN q ON event_type = grp)
SELECT grp, round(any_value(q1), 6) + 0.0 AS q1, round(any_value(m), 6) + 0.0 AS median, round(any_value(q3), 6) + 0.0 AS q3,
  min(value) FILTER (WHERE inside) AS whisker_low, max(value) FILTER (WHERE inside) AS whisker_high,
  count_if(NOT inside) AS outliers FROM j GROUP BY grp""")
def _(spark, table):
    df = table("events")
    levels = sorted(r[0] for r in df.select("event_type").distinct().collect())
    return rounded(profile.box_stats(df, "value", "event_type", levels), "q1", "median", "q3")


@query("density_2d", """
SELECT l_linestatus, CAST(floor(l_quantity / 5.0) AS INTEGER) AS bx, CAST(floor(l_extendedprice / 5.0 / 1000) AS INTEGER) AS by,
  count(*) AS rows FROM lineitem GROUP BY ALL""")
def _(spark, table):
    return profile.density_2d(table("lineitem"), F.col("l_quantity"), F.col("l_extendedprice") / 1000, 5.0, ["l_linestatus"])


@query("component_distribution", f"""
SELECT label, CAST(i AS INTEGER) AS component, count(*) AS rows, round(avg(x), 6) + 0.0 AS mean, round(stddev_samp(x), 6) + 0.0 AS std,
  round(min(x), 6) + 0.0 AS min, round(max(x), 6) + 0.0 AS max FROM {EMB_LONG} WHERE i < 6 GROUP BY label, i""")
def _(spark, table):
    return rounded(profile.component_distribution(embeddings(table), "v", "label"), "mean", "std", "min", "max")


@query("class_sample", f"""
SELECT vec_id, label, {', '.join(f'round(v[{i + 1}], 6) + 0.0 AS c{i}' for i in range(10))} FROM {EMB}
QUALIFY row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) <= 20""")
def _(spark, table):
    df = embeddings(table)
    classes = sorted(r[0] for r in df.select("label").distinct().collect())
    return profile.class_sample(df, "vec_id", "label", 20, classes).select(
        "vec_id", "label", *[rnd(F.col("v")[i]).alias(f"c{i}") for i in range(10)])


GRID1 = [1.0, 5.0, 10.0, 20.0, 40.0, 80.0, 160.0, 320.0]


@query("kde_1d", f"""
WITH s AS (SELECT event_type, var_samp(value) * pow(count(*), -0.4) AS h2 FROM events GROUP BY event_type)
SELECT event_type, gx, round(avg(exp(-0.5 * (value - gx) ** 2 / h2) / sqrt(2 * pi() * h2)), 9) + 0.0 AS density
FROM events JOIN s USING (event_type), (SELECT unnest({GRID1}::DOUBLE[]) AS gx) GROUP BY event_type, gx""")
def _(spark, table):
    return rounded(profile.kde(table("events"), [F.col("value")], [GRID1], "event_type"), "density", digits=9)


@query("kde_2d", """
WITH s AS (SELECT l_linestatus, pow(count(*), -1.0 / 3) AS f, var_samp(l_quantity) AS vx, var_samp(l_discount) AS vy,
  covar_samp(l_quantity, l_discount) AS c FROM lineitem GROUP BY l_linestatus),
i AS (SELECT *, vx * vy - c * c AS det FROM s)
SELECT l_linestatus, gx, gy, round(avg(exp(-0.5 * ((l_quantity - gx) ** 2 * vy - 2 * (l_quantity - gx) * (l_discount - gy) * c
  + (l_discount - gy) ** 2 * vx) / det / f) / (2 * pi() * sqrt(det) * f)), 6) + 0.0 AS density
FROM lineitem JOIN i USING (l_linestatus), (SELECT unnest([5.0, 25.0, 45.0]::DOUBLE[]) AS gx),
  (SELECT unnest([0.01, 0.05, 0.09]::DOUBLE[]) AS gy) GROUP BY ALL""")
def _(spark, table):
    return rounded(profile.kde(table("lineitem"), [F.col("l_quantity"), F.col("l_discount")],
                               [[5.0, 25.0, 45.0], [0.01, 0.05, 0.09]], "l_linestatus"), "density")


# ---- imputation and scaling ---------------------------------------------------------------------

HOLES = "(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_tax, 0.0) AS l_tax, nullif(l_discount, 0.0) AS l_discount FROM lineitem)"


def _holes(table):
    return table("lineitem").select(*LI_KEYS, *[F.nullif(c, F.lit(0.0)).alias(c) for c in ("l_tax", "l_discount")])


def _impute(name, how, fill):
    cols = ["l_tax", "l_discount"]

    @query(name, f"""SELECT {LI_ID}, {', '.join(
        f'round(coalesce({c}, {fill.format(c=c)}), 6) + 0.0 AS {c}' for c in cols)} FROM {HOLES}""")
    def _(spark, table):
        df = _holes(table)
        return rounded(prep.impute(df, cols, how).transform(df), *cols)


_impute("impute_median", "median", f"(SELECT quantile_cont({{c}}, 0.5) FROM {HOLES})")
_impute("impute_mean", "mean", f"(SELECT avg({{c}}) FROM {HOLES})")
_impute("impute_zero", "zero", "0.0")


def _scale(name, how, expr):
    @query(name, f"""SELECT {LI_ID}, {', '.join(
        f'round({expr.format(c=c)}, 6) + 0.0 AS {c}' for c in LI)} FROM lineitem""")
    def _(spark, table):
        df = table("lineitem").select(*LI_KEYS, *LI)
        return rounded(prep.scale(df, LI, how).transform(df), *LI)


_scale("scale_standard", "standard", "({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()")
_scale("scale_minmax", "minmax", "({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())")
_scale("scale_maxabs", "maxabs", "{c} / max(abs({c})) OVER ()")
_scale("scale_robust", "robust", "({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / "
       "(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem)")



@query("yeo_johnson_fixed", """
WITH t AS (SELECT event_id, value - 20 AS x FROM events)
SELECT event_id,
  round(CASE WHEN x >= 0 THEN (pow(x + 1, 0.3) - 1) / 0.3 ELSE -(pow(1 - x, 1.7) - 1) / 1.7 END, 6) + 0.0 AS a,
  round(CASE WHEN x >= 0 THEN ln(1 + x) ELSE -(pow(1 - x, 2.0) - 1) / 2.0 END, 6) + 0.0 AS b,
  round(CASE WHEN x >= 0 THEN (pow(x + 1, 2.0) - 1) / 2.0 ELSE -ln(1 - x) END, 6) + 0.0 AS c FROM t""")
def _(spark, table):
    df = table("events").select("event_id", *[(F.col("value") - 20).alias(c) for c in "abc"])
    out = prep.yeo_johnson_fixed({"a": 0.3, "b": 0.0, "c": 2.0}).transform(df)
    return rounded(out, "a", "b", "c")


@query("yeo_johnson_fit")
def _(spark, table):
    df = table("events").select("event_id", "value")
    return rounded(prep.fit_yeo_johnson(df, ["value"]).transform(df), "value", digits=4)


@query("site_residual", """
SELECT c_custkey, c_nationkey, round(c_acctbal - avg(c_acctbal) OVER (PARTITION BY c_nationkey), 6) + 0.0 AS c_acctbal
FROM customer""")
def _(spark, table):
    df = table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return rounded(prep.remove_site_effects(df, ["c_acctbal"], "c_nationkey"), "c_acctbal")


@query("adaptive_preprocess")
def _(spark, table):
    df = table("events").select("event_id", "event_type", "value", F.sqrt("value").alias("root"),
                                F.lit(1.0).alias("flat"))
    return rounded(prep.adaptive_preprocess(df, ["value", "root", "flat"])[0], "value", "root", digits=4)
