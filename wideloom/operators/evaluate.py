"""Scoring of cluster labels against classes, per run, from contingency tables.

Everything starts from ``groupBy(run..., label, cluster).count()``.  Rows never reach the
driver; later steps work on (classes x clusters) cells.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wideloom.functions.moments import class_moments
from wideloom.functions.vectors import to_matrix
from wideloom.operators.neighbors import block_join, choose_pivots, pair_distances
from wideloom.session import cut_lineage

METRICS = ("accuracy", "precision", "recall", "f1", "ari", "nmi")


def contingency(df: DataFrame, label: str, cluster: str, by: Sequence[str] = ()) -> DataFrame:
    return df.where(F.col(label).isNotNull() & F.col(cluster).isNotNull()).groupBy(
        *by, F.col(label).alias("label"), F.col(cluster).alias("cluster")).agg(F.count("*").alias("rows"))


def _margins(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    a = cells.groupBy(*by, "label").agg(F.sum("rows").alias("a"))
    b = cells.groupBy(*by, "cluster").agg(F.sum("rows").alias("b"))
    n = cells.groupBy(*by).agg(F.sum("rows").alias("n"))
    out = cells.join(a, [*by, "label"]).join(b, [*by, "cluster"])
    return out.join(n, list(by))


def agreement(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adjusted Rand index and NMI (arithmetic mean) of each run."""
    if not by:
        return agreement(cells.withColumn("_run", F.lit(0)), ["_run"]).drop("_run")

    def pairs(c: Column) -> Column:
        c = c.cast("double")
        return c * (c - 1) / 2

    m = _margins(cells, by)
    n, r = F.col("n").cast("double"), F.col("rows").cast("double")
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    # A margin of size s is seen once per cell of its row, weighted rows / s.
    s = m.groupBy(*by, "n").agg(
        F.sum(pairs(F.col("rows"))).alias("ij"),
        F.sum(pairs(F.col("a")) * r / a).alias("ai"),
        F.sum(pairs(F.col("b")) * r / b).alias("bj"),
        F.sum(r / n * F.log(n * r / (a * b))).alias("mi"),
        F.sum(-r / n * F.log(a / n)).alias("ha"),
        F.sum(-r / n * F.log(b / n)).alias("hb"))
    expected = F.col("ai") * F.col("bj") / F.nullif(pairs(F.col("n")), F.lit(0.0))
    top = (F.col("ai") + F.col("bj")) / 2
    span = top - expected
    ari = F.when(F.abs(span) > 1e-12 * F.greatest(top, F.lit(1.0)),
                 (F.col("ij") - expected) / F.nullif(span, F.lit(0.0))).otherwise(F.lit(1.0))
    mean_h = (F.col("ha") + F.col("hb")) / 2
    nmi = F.when(mean_h > 1e-15, F.greatest(F.col("mi"), F.lit(0.0)) / F.nullif(mean_h, F.lit(0.0))).otherwise(F.lit(1.0))
    return s.select(*by, ari.alias("ari"), nmi.alias("nmi"))


def majority_map(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Each cluster's most frequent class (lowest class on ties)."""
    by = list(by)
    most = cells.groupBy(*by, "cluster").agg(F.max("rows").alias("most"))
    return cells.join(most, [*by, "cluster"]).where("rows = most").groupBy(*by, "cluster").agg(F.min("label").alias("mapped"))


def align(cells: DataFrame, by: Sequence[str] = (), alignment: str = "auto") -> DataFrame:
    """Cluster -> class map of each run.

    ``auto``: with no more clusters than classes the one-to-one map with the best accuracy,
    otherwise each cluster's majority class.  ``majority``: always the majority class.
    """
    if alignment not in ("auto", "majority"):
        raise ValueError(f"unknown alignment {alignment!r}")
    if not by:
        return align(cells.withColumn("_run", F.lit(0)), ["_run"], alignment).drop("_run")
    by = list(by)
    if alignment == "majority":
        return majority_map(cells, by)
    sizes = cells.groupBy(*by).agg(F.count_distinct("label").alias("kc"), F.count_distinct("cluster").alias("kk"))
    tagged = cells.join(sizes, by)
    small = F.col("kk") <= F.col("kc")
    label_t, cluster_t = dict(cells.dtypes)["label"], dict(cells.dtypes)["cluster"]
    key_schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cells.schema.fields if f.name in by)
    schema = f"{key_schema}cluster {cluster_t}, mapped {label_t}"

    def best_map(pdf: pd.DataFrame) -> pd.DataFrame:
        classes, clusters = sorted(pdf["label"].unique()), sorted(pdf["cluster"].unique())
        m = np.zeros((len(clusters), len(classes)))
        for k, c, r in zip(pdf["cluster"], pdf["label"], pdf["rows"]):
            m[clusters.index(k), classes.index(c)] = r
        pick = best_assignment(m)
        out = pd.DataFrame({"cluster": clusters, "mapped": [classes[j] for j in pick]})
        for name in reversed(by):
            out.insert(0, name, pdf[name].iloc[0])
        return out

    one = tagged.where(small).drop("kc", "kk")
    exact = one.groupBy(*by).applyInPandas(best_map, schema)
    rest = majority_map(tagged.where(~small).drop("kc", "kk"), by)
    return exact.unionByName(rest)


def best_assignment(m: np.ndarray) -> list[int]:
    """Distinct column per row with the largest total; first in lexicographic order."""
    rows, cols = m.shape
    if math.perm(cols, rows) <= 50_000:
        best, pick = -1.0, None
        for perm in itertools.permutations(range(cols), rows):
            s = float(sum(m[i, j] for i, j in enumerate(perm)))
            if s > best:
                best, pick = s, perm
        return list(pick)
    # Shortest augmenting paths on costs.
    cost = m.max() - m
    u, v = np.zeros(rows + 1), np.zeros(cols + 1)
    owner = np.zeros(cols + 1, int)
    for i in range(1, rows + 1):
        owner[0], j0 = i, 0
        dist, prev, done = np.full(cols + 1, np.inf), np.zeros(cols + 1, int), np.zeros(cols + 1, bool)
        while owner[j0]:
            done[j0] = True
            free = np.flatnonzero(~done[1:]) + 1
            step = cost[owner[j0] - 1, free - 1] - u[owner[j0]] - v[free]
            better = step < dist[free]
            dist[free[better]], prev[free[better]] = step[better], j0
            j1 = free[dist[free].argmin()]
            d = dist[j1]
            u[owner[done]] += d
            v[done] -= d
            dist[~done] -= d
            j0 = j1
        while j0:
            owner[j0] = owner[prev[j0]]
            j0 = prev[j0]
    pick = [0] * rows
    for j in range(1, cols + 1):
        if owner[j]:
            pick[owner[j] - 1] = j - 1
    return pick


def classification(mapped: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1 from cells (by..., label, mapped, rows).

    Two classes and two mapped clusters (``binary``) score the larger class label as
    positive, otherwise the support-weighted mean over classes; empty denominators count 0.
    """
    by = list(by)
    flat = F.explode(F.array(
        F.struct(F.col("label").alias("c"), F.col("rows").alias("support"), F.lit(0).alias("guess"),
                 F.when(F.col("label") == F.col("mapped"), F.col("rows")).otherwise(0).alias("hit")),
        F.struct(F.col("mapped").alias("c"), F.lit(0).alias("support"), F.col("rows").alias("guess"),
                 F.lit(0).alias("hit"))))
    per = mapped.select(*by, "binary", flat.alias("x")).groupBy(*by, "binary", "x.c").agg(
        F.sum("x.support").alias("support"), F.sum("x.guess").alias("guess"), F.sum("x.hit").alias("hit"))

    def safe(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))

    prec, rec = safe(F.col("hit"), F.col("guess")), safe(F.col("hit"), F.col("support"))
    per = per.select(*by, "binary", "c", "support", "hit", prec.alias("p"), rec.alias("r"),
                     safe(2 * prec * rec, prec + rec).alias("f"))
    agg = per.groupBy(*by, "binary").agg(
        F.sum("hit").alias("hits"), F.sum("support").alias("n"),
        *[F.max_by(x, "c").alias(f"pos_{x}") for x in "prf"],
        *[F.sum(F.col(x) * F.col("support")).alias(f"w_{x}") for x in "prf"])

    def pick(x: str) -> Column:
        return F.when(F.col("binary"), F.col(f"pos_{x}")).otherwise(F.col(f"w_{x}") / F.col("n"))

    return agg.select(*by, (F.col("hits") / F.col("n")).alias("accuracy"),
                      pick("p").alias("precision"), pick("r").alias("recall"), pick("f").alias("f1"))


def score(df: DataFrame, label: str, cluster: str, by: Sequence[str] = (), alignment: str = "auto") -> DataFrame:
    """One row of all six metrics per run; ``alignment`` as in ``align``."""
    return score_cells(contingency(df, label, cluster, by), by, alignment)


def score_cells(cells: DataFrame, by: Sequence[str] = (), alignment: str = "auto") -> DataFrame:
    if not by:
        return score_cells(cells.withColumn("_run", F.lit(0)), ["_run"], alignment).drop("_run")
    by = list(by)
    # A small table that several steps read: fixed here so that the rows, and any model that
    # labels them, are evaluated once.
    cells = cut_lineage(cells)
    sizes = cells.groupBy(*by).agg(
        ((F.count_distinct("label") == 2) & (F.count_distinct("cluster") == 2)).alias("binary"))
    mapped = cells.join(align(cells, by, alignment), [*by, "cluster"])
    mapped = mapped.join(sizes, by)
    return classification(mapped, by).join(agreement(cells, by), by)


def majority_flip(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """0/1 clusters, flipped when cluster 0 holds more of class 1 than cluster 1 does;
    then accuracy, precision, recall and F1 of class 1."""
    cells = df.agg(*[F.count_if((F.col(label) == l) & (F.col(cluster) == c)).alias(f"c{l}{c}")
                     for l in (0, 1) for c in (0, 1)])
    flip = F.col("c10") > F.col("c11")
    tp = F.when(flip, F.col("c10")).otherwise(F.col("c11")).cast("double")
    fn = F.when(flip, F.col("c11")).otherwise(F.col("c10"))
    fp = F.when(flip, F.col("c00")).otherwise(F.col("c01"))
    tn = F.when(flip, F.col("c01")).otherwise(F.col("c00"))

    def safe(a, b):
        return F.coalesce(a / F.nullif(b.cast("double"), F.lit(0.0)), F.lit(0.0))

    return cells.select(flip.alias("flipped"), safe(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                        safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"),
                        safe(2 * tp, 2 * tp + fp + fn).alias("f1"))


def sensitivity_specificity(cells: DataFrame) -> DataFrame:
    """Per class: sensitivity and specificity when the class's row of the mapped confusion
    matrix (label, mapped, rows) is taken as positive."""
    per = cells.select(F.explode(F.array(
        F.struct(F.col("label").alias("c"), F.col("rows").alias("support"), F.lit(0).alias("guess"),
                 F.when(F.col("label") == F.col("mapped"), F.col("rows")).otherwise(0).alias("hit")),
        F.struct(F.col("mapped").alias("c"), F.lit(0).alias("support"), F.col("rows").alias("guess"),
                 F.lit(0).alias("hit")))).alias("x")).groupBy("x.c").agg(
        F.sum("x.support").alias("support"), F.sum("x.guess").alias("guess"), F.sum("x.hit").alias("hit"))
    n = cells.agg(F.sum("rows")).scalar()
    neg = F.nullif((n - F.col("support")).cast("double"), F.lit(0.0))
    return per.select(
        F.col("c").alias("label"),
        F.coalesce(F.col("hit") / F.nullif(F.col("support").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("sensitivity"),
        F.coalesce(1 - (F.col("guess") - F.col("hit")) / neg, F.lit(0.0)).alias("specificity"))


def row_normalised(cells: DataFrame) -> DataFrame:
    total = cells.groupBy("label").agg(F.sum("rows").alias("total"))
    return cells.join(total, "label").select(
        "label", "cluster", "rows", (F.col("rows") / F.col("total").cast("double")).alias("share"))


MAX_SUMMARY = 5_000_000  # numbers in the cluster summary that silhouette sends to tasks


def silhouette(df: DataFrame, vec: str, cluster: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean silhouette of each run with squared Euclidean distance, exact over all rows.

    The sum of squared distances from x to a cluster is ``n |x|^2 - 2 x.S + Q`` with the
    cluster's count, vector sum S and sum of squared norms Q, so no pair of rows is ever
    formed.  Vectors of one run must have one width.
    """
    if not by:
        return silhouette(df.withColumn("_run", F.lit(0)), vec, cluster, ["_run"]).drop("_run")
    by = list(by)
    base = df.where(F.col(cluster).isNotNull()).select(*by, F.col(cluster).alias("k"), F.col(vec).alias("v"))
    m = class_moments(base.withColumn("_width", F.size("v")), "v", [*by, "k", "_width"])
    size = m.agg(F.sum("_width").alias("s")).first()["s"] or 0
    if size > MAX_SUMMARY:
        raise ValueError(f"cluster summary of {size} numbers is too large to send to every task")
    stats: dict[tuple, dict] = {}
    for r in m.collect():
        n, mean, var = float(r["n"]), np.array(r["mean"]), np.array(r["var"])
        run = stats.setdefault(tuple(r[c] for c in by), {"k": [], "n": [], "s": [], "q": []})
        run["k"].append(r["k"])
        run["n"].append(n)
        run["s"].append(n * mean)
        run["q"].append(n * float((var + mean * mean).sum()))
    runs = [{"n": np.array(s["n"]), "s": np.array(s["s"]), "q": np.array(s["q"])} for s in stats.values()]
    ids = [(*key, k, g, i) for g, (key, s) in enumerate(stats.items()) for i, k in enumerate(s["k"])]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields[:-1])
    numbers = df.sparkSession.createDataFrame(ids, f"{types}, g int, j int")

    @arrow_udf("double")
    def row_score(v: pa.Array, g: pa.Array, j: pa.Array) -> pa.Array:
        g, j = g.to_numpy(zero_copy_only=False), j.to_numpy(zero_copy_only=False)
        out = np.zeros(len(g))
        for run in np.unique(g):
            at = np.flatnonzero(g == run)
            x, c, own = to_matrix(v.take(pa.array(at))), runs[run], j[at]
            total = (x * x).sum(1)[:, None] * c["n"] - 2 * (x @ c["s"].T) + c["q"]
            rows = np.arange(len(at))
            a = total[rows, own] / np.maximum(c["n"][own] - 1, 1)
            other = np.maximum(total / c["n"], 0)
            other[rows, own] = np.inf
            b = other.min(axis=1)
            top = np.maximum(a, b)
            ok = (c["n"][own] > 1) & np.isfinite(b) & (top > 0)
            out[at] = np.where(ok, (np.where(np.isfinite(b), b, 0) - a) / np.where(ok, top, 1), 0.0)
        return pa.array(out)

    several = [len(s["k"]) > 1 for s in stats.values()]
    scored = base.join(F.broadcast(numbers), [*by, "k"]).select(*by, "g", row_score("v", "g", "j").alias("sil"))
    mean = F.avg("sil")
    defined = F.array(*[F.lit(s) for s in several])[F.first("g")]
    return scored.groupBy(*by).agg(F.when(defined, mean).alias("silhouette"))


def silhouette_euclidean(df: DataFrame, key: str, vec: str, cluster: str) -> DataFrame:
    """Mean silhouette with the plain Euclidean distance, exact.

    Distances to every other row are needed, so the work grows with rows squared; prefer
    :func:`silhouette` for large tables.  Blocks of rows meet blocks of rows, and a unit
    returns one vector of per-cluster distance sums per row, never its pairs.
    """
    data = df.where(F.col(cluster).isNotNull())
    sizes = {r[0]: r[1] for r in data.groupBy(cluster).count().orderBy(cluster).limit(MAX_CLUSTERS + 1).collect()}
    if len(sizes) > MAX_CLUSTERS:
        raise ValueError(f"more than {MAX_CLUSTERS} clusters")
    if len(sizes) < 2:
        return df.sparkSession.createDataFrame([(None,)], "silhouette double")
    names, n = list(sizes), np.array(list(sizes.values()), float)
    number = F.array_position(F.array(*[F.lit(k) for k in names]), F.col(cluster)).cast("int") - 1
    coded = data.select(F.col(key).cast("bigint").alias("key"), F.col(vec).alias("vec"), number.alias("j"))

    def sums(q, d, tiles):
        hot = np.zeros((len(d["key"]), len(names)))
        hot[np.arange(len(hot)), d["j"]] = 1.0
        total = np.zeros((len(q["key"]), len(names)))
        for tile, spans in tiles:
            for lo, hi in d.pieces(spans):
                dist = pair_distances(q["vec"][tile], d["vec"][lo:hi])
                dist[q["key"][tile][:, None] == d["key"][None, lo:hi]] = 0.0
                total[tile] += dist @ hot[lo:hi]
        return {"key": q["key"], "j": q["j"], "total": total}

    pivots = choose_pivots(coded, "key", "vec", int(n.sum()))
    parts = block_join(coded, "key", "vec", pivots, F.lit(1e300), sums, "key bigint, j int, total array<double>", ["j"])
    per = parts.groupBy("key", "j").agg(*[F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(len(names))])

    def row_score(t, j):
        rows = np.arange(len(j))
        a = t[rows, j] / np.maximum(n[j] - 1, 1)
        other = t / n
        other[rows, j] = np.inf
        b = other.min(axis=1)
        top = np.maximum(a, b)
        return np.where((n[j] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)

    @arrow_udf("double")
    def run(t: pa.Array, j: pa.Array) -> pa.Array:
        return pa.array(row_score(to_matrix(t), j.to_numpy(zero_copy_only=False))) if len(j) else pa.array([], pa.float64())

    return per.select(run(F.array(*[f"t{i}" for i in range(len(names))]), "j").alias("s")).agg(F.avg("s").alias("silhouette"))


MAX_CLUSTERS = 200


# ---- result tables -------------------------------------------------------------------

def best_by(results: DataFrame, metric: str, order: str) -> DataFrame:
    """The run with the highest metric; the first in ``order`` on ties."""
    return results.orderBy(F.desc(metric), order).limit(1)


def rank_results(results: DataFrame, metric: str, order: Sequence[str]) -> DataFrame:
    """A result table (one row per run) sorted by the metric, numbered from 0."""
    w = Window.orderBy(F.desc(metric), *order)
    return results.withColumn("position", (F.row_number().over(w) - 1).cast("int"))


def pivot_best(results: DataFrame, rows: str, cols: str, values: Sequence[str], metric: str) -> DataFrame:
    return results.groupBy(rows).pivot(cols, list(values)).agg(F.max(metric))


def win_counts(results: DataFrame, a: str, b: str) -> DataFrame:
    return results.agg(F.count_if(F.col(a) > F.col(b)).alias(f"{a}_wins"),
                       F.count_if(F.col(b) > F.col(a)).alias(f"{b}_wins"),
                       F.count_if(F.col(a) == F.col(b)).alias("ties"))


def elbow(scores: DataFrame, k: str, inertia: str) -> DataFrame:
    """The k with the smallest second difference of the inertia (first on ties)."""
    w = Window.orderBy(k)
    second = (F.lead(inertia).over(w) - F.col(inertia)) - (F.col(inertia) - F.lag(inertia).over(w))
    return scores.select(k, second.alias("second")).where("second IS NOT NULL").orderBy("second", k).limit(1).select(k)
