"""Profiling: column statistics, group tests, correlations and the data behind plots."""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions import stats as S
from wideloom.functions.joins import measured_broadcast
from wideloom.functions.moments import moments_long
from wideloom.functions.vectors import pack
from wideloom.operators.quantiles import exact_quantiles
from wideloom.operators.ranks import cumulative, melt
from wideloom.operators.rowsums import sum_rows

CHUNK = 300


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of each column as (column, value)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(pairs.alias("p")).select("p.*").distinct()


def missing_counts(df: DataFrame, cols: Sequence[str], only_missing: bool = True) -> DataFrame:
    numeric = {c for c, t in df.dtypes if t in ("double", "float")}
    one = df.agg(*[
        F.count_if(F.col(c).isNull() | (F.isnan(c) if c in numeric else F.lit(False))).alias(c) for c in cols])
    out = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in cols])).alias("p")).select("p.*")
    return out.where("missing > 0") if only_missing else out


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (ddof 1), min, max, corrected skewness and kurtosis per column."""
    frames = []
    for at in range(0, len(cols), CHUNK // 7):
        part = cols[at:at + CHUNK // 7]
        aggs = []
        for i, c in enumerate(part):
            x = S.clean(F.col(c))
            aggs.append(F.struct(
                F.lit(c).alias("feature"), F.count(x).alias("n"), F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
                F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2")).alias(f"s{i}"))
        one = df.agg(*aggs)
        frames.append(one.select(F.explode(F.array(*[f"s{i}" for i in range(len(part))])).alias("s")).select("s.*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.select(
        "feature", F.col("n").alias("count"), "mean", "std", "min", "max",
        S.sample_skew(F.col("g1"), F.col("n")).alias("skewness"),
        S.sample_kurtosis(F.col("g2"), F.col("n")).alias("kurtosis"))


def skew_buckets(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    a = F.abs("skewness")
    return describe(df, cols).select(
        "feature", "skewness",
        F.when(a > 1, "high").when(a > 0.5, "moderate").otherwise("low").alias("bucket"))


def jarque_bera(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Normality from moments over all rows; the p-value is the chi-square(2) tail."""
    aggs = [F.struct(F.lit(c).alias("feature"), F.count(c).alias("n"), F.skewness(c).alias("g1"),
                     F.kurtosis(c).alias("g2")).alias(f"s{i}") for i, c in enumerate(cols)]
    s = df.agg(*aggs).select(F.explode(F.array(*[f"s{i}" for i in range(len(cols))])).alias("s")).select("s.*")
    jb = F.col("n") / 6.0 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4.0)
    p = F.exp(-jb / 2)
    return s.select("feature", F.col("n").alias("count"), jb.alias("jb"), p.alias("p_value"),
                    (p < 0.05).alias("rejected"))


# Polynomials of Royston's 1995 approximation (AS R94), lowest power first.
ROYSTON_LAST = (0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056)
ROYSTON_SECOND = (0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633)
ROYSTON_SMALL_MEAN = (0.544, -0.39978, 0.025054, -6.714e-4)
ROYSTON_SMALL_SD = (1.3822, -0.77857, 0.062767, -0.0020322)
ROYSTON_MEAN = (-1.5861, -0.31082, -0.083751, 0.0038915)
ROYSTON_SD = (-0.4803, -0.082676, 0.0030302)
ROYSTON_GAMMA = (-2.273, 0.459)


ROYSTON_ROWS = 5000  # the p-value's approximation was fitted up to here
TIE_BLOCK = 10_000


def shapiro_wilk(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Shapiro-Wilk W per feature over all rows, and p where Royston's approximation holds.

    Ranks come from pre-aggregated values, so no feature is sorted in one task; a value with many
    copies is spread over its ranks in blocks.  Beyond ROYSTON_ROWS rows p and the verdict are null.
    """
    long = melt(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = cumulative(long, ["feature"], "value", {"t": F.count("*")})
    sizes = ranks.groupBy("feature").agg(F.sum("t").cast("double").alias("n"))
    blocks = ranks.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("t") - 1) / TIE_BLOCK))))
    first = F.col("b") * TIE_BLOCK
    x = blocks.select("feature", "value", (F.col("before_t") + first).alias("low"),
                      F.least(F.lit(TIE_BLOCK).cast("bigint"), F.col("t") - first).alias("some")).select(
        "feature", "value", "low", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("some"))).alias("one"))
    x = x.join(F.broadcast(sizes), "feature").select(  # one row per column name
        "feature", "value", (F.col("low") + F.col("one")).cast("double").alias("i"), "n")
    x = S.add_normal_quantile(x, (F.col("i") - 0.375) / (F.col("n") + 0.25), "m")
    sums = x.groupBy("feature", "n").agg(
        F.sum(F.col("m") * F.col("m")).alias("mm"),
        F.max("m").alias("m1"),
        F.max_by("m", F.when(F.col("i") < F.col("n"), F.col("i"))).alias("m2"),
        F.avg("value").alias("mean"))
    rsn = 1 / F.sqrt("n")
    last = S.poly(F.col("rsn"), ROYSTON_LAST) + F.col("m1") / F.sqrt("mm")
    second = S.poly(F.col("rsn"), ROYSTON_SECOND) + F.col("m2") / F.sqrt("mm")
    sums = sums.withColumn("rsn", rsn)
    s = sums.select("feature", "n", "mean",
                    F.when(F.col("n") == 3, F.lit(math.sqrt(0.5))).otherwise(last).alias("a1"),
                    second.alias("a2"), "mm", "m1", "m2")
    big = F.col("n") > 5
    num = F.when(big, F.col("mm") - 2 * F.col("m1") ** 2 - 2 * F.col("m2") ** 2).otherwise(
        F.col("mm") - 2 * F.col("m1") ** 2)
    den = F.when(big, 1 - 2 * F.col("a1") ** 2 - 2 * F.col("a2") ** 2).otherwise(1 - 2 * F.col("a1") ** 2)
    s = s.withColumn("scale", F.when(F.col("n") > 3, F.sqrt(num / F.nullif(den, F.lit(0.0)))).otherwise(F.lit(1.0)))
    j = x.join(F.broadcast(s.drop("n", "mm", "m1", "m2")), "feature")
    edge = F.least(F.col("i"), F.col("n") + 1 - F.col("i"))
    side = F.when(F.col("i") * 2 > F.col("n") + 1, F.lit(1.0)).otherwise(F.lit(-1.0))
    weight = (F.when(edge == 1, side * F.col("a1"))
              .when((edge == 2) & big, side * F.col("a2"))
              .otherwise(F.when(F.col("n") == 3, F.lit(0.0)).otherwise(F.col("m") / F.col("scale"))))
    d = F.col("value") - F.col("mean")
    w = j.groupBy("feature", "n").agg(
        F.sum(weight * d).alias("ax"), F.sum(d * d).alias("ss")
    ).select("feature", "n", S.ratio(F.col("ax") ** 2, F.col("ss")).alias("w"))
    w = w.withColumn("ln", F.log("n")).withColumn("y", F.log(1 - F.col("w"))).withColumn(
        "small", -F.log(F.greatest(S.poly(F.col("n"), ROYSTON_GAMMA) - F.col("y"), F.lit(1e-300))))
    z = F.when(
        F.col("n") <= 11,
        (F.col("small") - S.poly(F.col("n"), ROYSTON_SMALL_MEAN)) / F.exp(S.poly(F.col("n"), ROYSTON_SMALL_SD))
    ).otherwise((F.col("y") - S.poly(F.col("ln"), ROYSTON_MEAN)) / F.exp(S.poly(F.col("ln"), ROYSTON_SD)))
    three = 6 / math.pi * (F.asin(F.sqrt("w")) - math.asin(math.sqrt(0.75)))
    w = S.add_normal_tail(w, z, "tail", upper=True).withColumn(
        "p_value", F.when(F.col("w") >= 1, F.lit(1.0)).when(
            F.col("n") == 3, F.greatest(three, F.lit(0.0))).otherwise(F.col("tail")))
    p = F.when(F.col("n") <= ROYSTON_ROWS, F.col("p_value"))
    return w.select("feature", F.col("n").cast("bigint").alias("count"), "w", p.alias("p_value"), (p < 0.05).alias("rejected"))


def group_sizes(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), col)


def mann_whitney(df: DataFrame, cols: Sequence[str], group: str, first, second) -> DataFrame:
    """Two-sided Mann-Whitney U per feature: mid-ranks, tie-corrected z with continuity
    correction, normal p-value.  Features with an empty group are left out."""
    long = melt(df.where(F.col(group).isin(first, second)), cols, [F.col(group).alias("grp")])
    long = long.where(~F.isnan("value"))
    ranks = cumulative(long, ["feature"], "value", {
        "a": F.count_if(F.col("grp") == F.lit(first)), "t": F.count("*")})
    t = F.col("t").cast("double")
    mid = F.col("before_t") + (t + 1) / 2
    per = ranks.groupBy("feature").agg(
        F.sum(F.col("a") * mid).alias("rank_sum"), F.sum("a").alias("n1"), F.sum("t").alias("n"),
        F.sum(t * t * t - t).alias("ties")).where("n1 > 0 AND n1 < n")
    n, n1 = F.col("n").cast("double"), F.col("n1").cast("double")
    n2 = n - n1
    per = per.withColumn("u", F.col("rank_sum") - n1 * (n1 + 1) / 2).withColumn(
        "sd", F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("ties") / (n * (n - 1)))))
    per = per.withColumn("z", (F.greatest(F.col("u"), n1 * n2 - F.col("u")) - n1 * n2 / 2 - 0.5)
                         / F.nullif("sd", F.lit(0.0)))
    per = S.add_normal_tail(per, F.col("z"), "tail", upper=True).withColumn(
        "p_value", F.least(F.lit(1.0), 2 * F.col("tail")))
    return per.select(
        "feature", F.col("n1").cast("bigint").alias("n1"), n2.cast("bigint").alias("n2"),
        "u", "z", "p_value", (F.col("p_value") < 0.05).alias("significant"))


def correlations(df: DataFrame, cols: Sequence[str], how: str = "corr") -> DataFrame:
    """Upper triangle of the correlation (or sample covariance) matrix as (a, b, value).

    One pass for any number of columns: each pair sums over the rows that have both values.  A
    correlation with a constant column, and any pair with fewer than two rows, is null.
    """
    if how not in ("corr", "cov"):
        raise ValueError(f"unknown matrix {how!r}")
    cols = list(cols)
    p = len(cols)
    # Values are taken relative to one of their own column, so a constant column sums to exactly 0.
    clean = [S.clean(F.col(c)) for c in cols]
    pilot = list(df.limit(64).agg(*[F.first(c, True) for c in clean]).first())
    late = [i for i, v in enumerate(pilot) if v is None]
    if late:
        for i, v in zip(late, df.agg(*[F.first(clean[i], True) for i in late]).first()):
            pilot[i] = 0.0 if v is None else v
    pilot = np.array(pilot, float)

    def part(x):
        m = ~np.isnan(x)
        z, m = np.where(m, x - pilot, 0.0), m.astype(float)
        return m.T @ m, z.T @ m, (z * z).T @ m, z.T @ z

    try:
        n, s, q, xy = sum_rows(df.select(pack(clean).alias("v")), ["v"], part, numbers=4 * p * p, complete=False)
    except ValueError:  # no rows
        n, s, q, xy = np.zeros((4, p, p))
    i, j = np.triu_indices(p, 1 if how == "corr" else 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        c = xy[i, j] - s[i, j] * s[j, i] / n[i, j]
        if how == "cov":
            value, known = c / (n[i, j] - 1), n[i, j] >= 2
        else:
            spread = (q[i, j] - s[i, j] ** 2 / n[i, j]) * (q[j, i] - s[j, i] ** 2 / n[i, j])
            varies = np.diag(q) > 0
            value, known = np.clip(c / np.sqrt(spread), -1, 1), (n[i, j] >= 2) & varies[i] & varies[j] & (spread > 0)
    names = pa.array(cols)
    return df.sparkSession.createDataFrame(pa.table({
        "a": names.take(pa.array(i)), "b": names.take(pa.array(j)), "value": pa.array(value, mask=~known)}))


def top_correlated_pairs(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    return correlations(df, cols).where("value IS NOT NULL").orderBy(F.desc(F.abs("value")), "a", "b").limit(k)


def iqr_outliers(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Quartiles, fences and the number of values outside them per column."""
    q = exact_quantiles(df, {c: S.clean(F.col(c)) for c in cols}, [0.25, 0.75])
    items = []
    for c in cols:
        q1, q3 = q[c]
        if q1 is None:
            continue
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = S.clean(F.col(c))
        items.append(F.struct(F.lit(c).alias("feature"), F.lit(q1).alias("q1"), F.lit(q3).alias("q3"),
                              F.lit(lo).alias("lower"), F.lit(hi).alias("upper"),
                              F.count_if((x < lo) | (x > hi)).alias("outliers")).alias(f"s{len(items)}"))
    one = df.agg(*items)
    return one.select(F.explode(F.array(*[f"s{i}" for i in range(len(items))])).alias("s")).select("s.*")


def preprocessing_advice(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: highly and moderately skewed features, outlier flag over all columns, scaler to use."""
    skew = skew_buckets(df, cols).groupBy().agg(
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("bucket") == "high", F.col("feature")))), ",")
        .alias("highly_skewed"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("bucket") == "moderate", F.col("feature")))), ",")
        .alias("moderately_skewed"))
    out = iqr_outliers(df, list(cols)).agg((F.sum("outliers") > 0).alias("has_outliers"))
    return skew.withColumn("has_outliers", out.scalar()).withColumn(
        "scaler", F.when(F.col("has_outliers"), "robust").otherwise("standard"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    lo, hi = float(lo), float(hi)
    w = (hi - lo) / bins or 1.0
    b = F.least(F.floor((F.col(col) - lo) / w), F.lit(bins - 1)).cast("int")
    return df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("rows")).select(
        "bin", (F.lit(lo) + F.col("bin") * w).alias("left_edge"),
        (F.lit(lo) + (F.col("bin") + 1) * w).alias("right_edge"), "rows")


def qq_points(df: DataFrame, col: str) -> DataFrame:
    """Normal Q-Q data: per distinct value its rank range and the theoretical quantile of
    the Filliben median position of its mid-rank."""
    n = df.where(F.col(col).isNotNull()).count()
    r = cumulative(df.select(F.col(col).cast("double").alias("value")), [], "value", {"t": F.count("*")})
    mid = F.col("before_t") + (F.col("t") + 1) / 2.0
    top, m = 0.5 ** (1.0 / n), F.col("mid_rank")
    pos = F.when(m == 1, F.lit(1 - top)).when(m == n, F.lit(top)).otherwise((m - 0.3175) / (n + 0.365))
    return S.add_normal_quantile(r.withColumn("mid_rank", mid), pos, "theoretical").select(
        "value", F.col("t").alias("rows"), "mid_rank", "theoretical")


def box_stats(df: DataFrame, col: str, group: str, levels: Sequence) -> DataFrame:
    """Quartiles, whisker ends and outlier count of a column per group."""
    x = S.clean(F.col(col))
    q = exact_quantiles(
        df, {v: F.when(F.col(group) == F.lit(v), x) for v in levels}, [0.25, 0.5, 0.75])
    spark = df.sparkSession
    fences = spark.createDataFrame(
        [(v, *map(float, q[v]), q[v][0] - 1.5 * (q[v][2] - q[v][0]), q[v][2] + 1.5 * (q[v][2] - q[v][0]))
         for v in levels if q[v][0] is not None],
        "grp string, q1 double, median double, q3 double, lo double, hi double")
    j = df.select(F.col(group).cast("string").alias("grp"), x.alias("x")).join(F.broadcast(fences), "grp")
    inside = F.col("x").between(F.col("lo"), F.col("hi"))
    return j.groupBy("grp").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"), F.count_if(~inside).alias("outliers"))


def density_2d(df: DataFrame, x: Column, y: Column, step: float, by: Sequence[str] = ()) -> DataFrame:
    """Row counts on a square grid, per group."""
    return df.groupBy(*by, F.floor(x / step).cast("int").alias("bx"), F.floor(y / step).cast("int").alias("by")
                      ).agg(F.count("*").alias("rows"))


def region(df: DataFrame, x: Column, y: Column, low: float, high: float) -> DataFrame:
    """Rows whose first two components lie in the open square (low, high)."""
    return df.where((x > low) & (x < high) & (y > low) & (y < high))


def component_distribution(df: DataFrame, vec: str, label: str, components: int = 6) -> DataFrame:
    """Moments of the first components per class."""
    first = df.select(F.col(label).alias("label"), F.slice(vec, 1, components).alias("v"))
    return moments_long(first, "v", ["label"]).select(
        "label", F.col("i").alias("component"), F.col("n").alias("rows"), "mean",
        F.sqrt(F.col("var") * F.col("n") / F.nullif(F.col("n") - 1, F.lit(0))).alias("std"), "min", "max")


def class_sample(df: DataFrame, key: str, label: str, per_class: int, classes: Sequence) -> DataFrame:
    """Up to ``per_class`` rows of each class, in MD5 order of the key.

    One top-k per class (the classes are few), never a window over a whole class.
    """
    code = F.md5(F.col(key).cast("string"))
    parts = [df.where(F.col(label) == F.lit(c)).orderBy(code, key).limit(per_class) for c in classes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def kde(df: DataFrame, dims: Sequence[Column], grids: Sequence[Sequence[float]], by: str,
        bandwidths: dict | None = None) -> DataFrame:
    """Gaussian kernel density of one or two columns per class on a fixed grid.

    Scott's rule per class (``n ** (-1 / (d + 4))`` times the covariance) unless given.
    Each row adds its kernel to every grid cell inside one array aggregate, so the
    shuffle carries (classes x grid cells), not (rows x grid cells).
    """
    d = len(dims)
    if d not in (1, 2):
        raise ValueError("one or two dimensions")
    x, y = dims[0].cast("double"), dims[-1].cast("double")
    st = df.groupBy(by).agg(F.count("*").alias("n"), F.var_samp(x).alias("vx"), F.var_samp(y).alias("vy"),
                            F.covar_samp(x, y).alias("cxy"))
    h2 = F.pow(F.col("n").cast("double"), F.lit(-2.0 / (d + 4)))
    if d == 1:
        st = st.select(F.col(by), "n", (1 / (F.col("vx") * h2)).alias("i11"), F.lit(0.0).alias("i12"),
                       F.lit(0.0).alias("i22"),
                       (1 / F.sqrt(2 * math.pi * F.col("vx") * h2)).alias("norm"))
    else:
        det = F.col("vx") * F.col("vy") - F.col("cxy") ** 2
        st = st.select(F.col(by), "n", (F.col("vy") / det / h2).alias("i11"), (-F.col("cxy") / det / h2).alias("i12"),
                       (F.col("vx") / det / h2).alias("i22"),
                       (1 / (2 * math.pi * F.sqrt(det) * h2)).alias("norm"))
    points = list(itertools.product(*grids))
    j = df.select(F.col(by), x.alias("x"), y.alias("y")).join(measured_broadcast(st), by)
    out = []
    for at in range(0, len(points), CHUNK):
        part = points[at:at + CHUNK]
        aggs = []
        for i, p in enumerate(part):
            dx = F.col("x") - float(p[0])
            dy = F.col("y") - float(p[-1])
            quad = dx * dx * F.col("i11")
            if d == 2:
                quad = quad + 2 * dx * dy * F.col("i12") + dy * dy * F.col("i22")
            aggs.append(F.avg(F.exp(-0.5 * quad) * F.col("norm")).alias(f"g{i}"))
        one = j.groupBy(by).agg(*aggs)
        cells = [F.struct(F.lit(float(p[0])).alias("gx"), *([F.lit(float(p[1])).alias("gy")] if d == 2 else []),
                          F.col(f"g{i}").alias("density")) for i, p in enumerate(part)]
        out.append(one.select(by, F.explode(F.array(*cells)).alias("c")).select(by, "c.*"))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res
