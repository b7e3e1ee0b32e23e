"""Imputation, scaling, power transform, outlier policies and site correction.

Every ``fit`` runs one or a few aggregations and returns a ``ColumnMap``: plain column
expressions over literal statistics, so ``transform`` stays a codegen'd projection and
works on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions import stats as S
from wideloom.functions.joins import join_groups
from wideloom.functions.vectors import pack
from wideloom.operators import profile
from wideloom.operators.quantiles import exact_quantiles
from wideloom.operators.rowsums import sum_rows

MAX_DOUBLE = 1.7976931348623157e308


@dataclass
class ColumnMap:
    """Fitted per-column rewrite; ``params`` keeps the statistics it was built from."""

    exprs: dict[str, Column]
    params: dict[str, dict[str, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.exprs)


def _stats(df: DataFrame, cols: Sequence[str], **fns) -> dict[str, dict[str, float]]:
    """``{column: {name: value}}`` in as few passes as codegen limits allow."""
    out: dict[str, dict[str, float]] = {}
    step = max(1, profile.CHUNK // len(fns))
    for at in range(0, len(cols), step):
        part = cols[at:at + step]
        row = df.agg(*[fn(S.clean(F.col(c))).alias(f"{n}_{i}") for i, c in enumerate(part) for n, fn in fns.items()]
                     ).first()
        for i, c in enumerate(part):
            out[c] = {n: row[f"{n}_{i}"] for n in fns}
    return out


def impute(df: DataFrame, cols: Sequence[str], how: str) -> ColumnMap:
    """``median``, ``mean``, or ``zero`` (which also clamps infinities to the double range)."""
    if how == "zero":
        return ColumnMap({c: F.least(F.greatest(F.coalesce(S.clean(F.col(c)), F.lit(0.0)), F.lit(-MAX_DOUBLE)),
                                     F.lit(MAX_DOUBLE)) for c in cols})
    if how == "mean":
        fill = {c: s["mean"] for c, s in _stats(df, cols, mean=F.avg).items()}
    elif how == "median":
        fill = {c: q[0] for c, q in exact_quantiles(df, {c: S.clean(F.col(c)) for c in cols}, [0.5]).items()}
    else:
        raise ValueError(f"unknown imputation {how!r}")
    return ColumnMap({c: F.coalesce(S.clean(F.col(c)), F.lit(v)) for c, v in fill.items()},
                     {c: {"fill": v} for c, v in fill.items()})


def scale(df: DataFrame, cols: Sequence[str], how: str = "standard") -> ColumnMap:
    """``standard`` (ddof 0), ``robust`` (median/IQR), ``minmax`` or ``maxabs``.
    A zero spread divides by one."""
    if how == "standard":
        s = {c: (v["a"], v["b"]) for c, v in _stats(df, cols, a=F.avg, b=F.stddev_pop).items()}
    elif how == "minmax":
        s = {c: (v["a"], v["b"] - v["a"]) for c, v in _stats(df, cols, a=F.min, b=F.max).items()}
    elif how == "maxabs":
        s = {c: (0.0, v["b"]) for c, v in _stats(df, cols, b=lambda x: F.max(F.abs(x))).items()}
    elif how == "robust":
        q = exact_quantiles(df, {c: S.clean(F.col(c)) for c in cols}, [0.25, 0.5, 0.75])
        s = {c: (v[1], v[2] - v[0]) for c, v in q.items()}
    else:
        raise ValueError(f"unknown scaling {how!r}")
    exprs, params = {}, {}
    for c, (shift, spread) in s.items():
        spread = spread or 1.0
        x = S.clean(F.col(c))
        exprs[c] = (x / F.lit(spread)) if how == "maxabs" else (x - F.lit(shift)) / F.lit(spread)
        params[c] = {"shift": shift, "spread": spread}
    return ColumnMap(exprs, params)


def yeo_johnson_fixed(cols: dict[str, float]) -> ColumnMap:
    return ColumnMap({c: S.yeo_johnson(S.clean(F.col(c)), lam) for c, lam in cols.items()},
                     {c: {"lambda": lam} for c, lam in cols.items()})


def _yj(x: np.ndarray, lam: float) -> np.ndarray:
    out = np.empty_like(x)
    pos = x >= 0
    out[pos] = np.log1p(x[pos]) if abs(lam) < 1e-12 else np.expm1(lam * np.log1p(x[pos])) / lam
    neg = ~pos
    out[neg] = (-np.log1p(-x[neg]) if abs(lam - 2) < 1e-12
                else -np.expm1((2 - lam) * np.log1p(-x[neg])) / (2 - lam))
    return out


def fit_yeo_johnson(
    df: DataFrame, cols: Sequence[str], low: float = -4.0, high: float = 6.0, points: int = 21, rounds: int = 6
) -> ColumnMap:
    """Per-column maximum-likelihood lambda by grid refinement, then standardised.

    Each round scores a whole lambda grid for every column in one pass over the rows; the
    bracket shrinks tenfold per round.  While the best value is at an end of a bracket that has not
    shrunk yet, the bracket widens instead.
    """
    cols = list(cols)
    vec = df.where(~F.exists(pack(cols), lambda x: x.isNull() | F.isnan(x))).select(pack(cols).alias("v"))
    shape = (len(cols), points)
    lo, hi = np.full(len(cols), low), np.full(len(cols), high)
    shrunk, done = np.zeros(len(cols), int), 0
    while done < rounds + 20 and (shrunk < rounds).any():
        done += 1
        grid = np.linspace(lo, hi, points, axis=1)
        pilot = np.array([[_yj(np.zeros(1), g)[0] for g in row] for row in grid])

        def score(x, grid=grid, pilot=pilot):
            s1, s2 = np.zeros(shape), np.zeros(shape)
            for i in range(shape[0]):
                for j in range(shape[1]):
                    y = _yj(x[:, i], grid[i, j]) - pilot[i, j]
                    s1[i, j], s2[i, j] = y.sum(), (y * y).sum()
            jac = (np.sign(x) * np.log1p(np.abs(x))).sum(axis=0)
            return np.array([float(len(x))]), s1, s2, jac

        n, s1, s2, jac = sum_rows(vec, ["v"], score, numbers=2 * grid.size + len(cols) + 1)
        var = np.maximum(s2 / n - (s1 / n) ** 2, 1e-300)
        ll = -n / 2 * np.log(var) + (grid - 1) * jac[:, None]
        best = ll.argmax(axis=1)
        rows = np.arange(len(cols))
        width = (hi - lo) / (points - 1)
        edge = (shrunk == 0) & ((best == 0) | (best == points - 1)) & (np.abs(grid[rows, best]) < 1000)
        wide = np.where(edge, hi - lo, width)
        lo, hi = grid[rows, best] - wide, grid[rows, best] + wide
        shrunk = shrunk + ~edge
    lam = (lo + hi) / 2
    power = yeo_johnson_fixed(dict(zip(cols, map(float, lam))))
    tall = scale(power.transform(df), cols, "standard")
    exprs = {c: (power.exprs[c] - F.lit(tall.params[c]["shift"])) / F.lit(tall.params[c]["spread"]) for c in cols}
    return ColumnMap(exprs, {c: {"lambda": float(lam[i]), **tall.params[c]} for i, c in enumerate(cols)})


# ---- outliers ----------------------------------------------------------------------

def outlier_mask(df: DataFrame, cols: Sequence[str], threshold: float = 3.0, out: str = "is_outlier") -> DataFrame:
    """Row flag: any feature with ``|x - mean| / std > threshold`` (ddof 0).  Constant
    columns and missing values never flag a row."""
    return _flagged(df, _stats(df, cols, mean=F.avg, sd=F.stddev_pop), threshold, out)


def _flagged(df: DataFrame, st: dict, threshold: float, out: str) -> DataFrame:
    hit = F.lit(False)
    for c, v in st.items():
        if v["sd"]:
            z = F.abs((S.clean(F.col(c)) - F.lit(v["mean"])) / F.lit(v["sd"]))
            hit = hit | F.coalesce(z > F.lit(float(threshold)), F.lit(False))
    return df.withColumn(out, hit)


def handle_outliers(
    df: DataFrame, cols: Sequence[str], method: str = "winsorize", threshold: float = 3.0, max_share: float = 0.3
) -> DataFrame:
    """``none`` flags; ``remove`` drops flagged rows when they are under ``max_share`` of
    all rows, else keeps everything; ``winsorize`` clips to mean +- threshold * std."""
    st = _stats(df, cols, mean=F.avg, sd=F.stddev_pop)
    flagged = _flagged(df, st, threshold, "is_outlier")
    if method == "none":
        return flagged
    if method == "remove":
        n, bad = flagged.agg(F.count("*"), F.count_if("is_outlier")).first()
        return flagged.where(~F.col("is_outlier")) if bad < n * max_share else flagged
    if method == "winsorize":
        bounds = {c: (v["mean"] - threshold * v["sd"], v["mean"] + threshold * v["sd"])
                  for c, v in st.items() if v["sd"] is not None}
        return flagged.withColumns({
            c: F.least(F.greatest(S.clean(F.col(c)), F.lit(lo)), F.lit(hi)) for c, (lo, hi) in bounds.items()})
    raise ValueError(f"unknown outlier handling {method!r}")


def remove_or_rescale(df: DataFrame, cols: Sequence[str], threshold: float = 5.0, max_share: float = 0.3) -> DataFrame:
    """Drop outlier rows when they are few, else keep all rows and robust-scale them."""
    flagged = outlier_mask(df, cols, threshold)
    n, bad = flagged.agg(F.count("*"), F.count_if("is_outlier")).first()
    if 0 < bad < n * max_share:
        return flagged.where(~F.col("is_outlier")).drop("is_outlier").withColumn("policy", F.lit("removed"))
    if bad == 0:
        return scale(df, cols, "standard").transform(df).withColumn("policy", F.lit("standard"))
    return scale(df, cols, "robust").transform(df).withColumn("policy", F.lit("robust"))


def remove_site_effects(df: DataFrame, cols: Sequence[str], site: str) -> DataFrame:
    """Residual of the regression on site dummies: the value minus its site mean.

    Site means are aggregated first (map-side) and joined back, so a site holding a third
    of the rows is never gathered in one task as a window would do.
    """
    means = df.groupBy(site).agg(F.count("*").alias("_rows"), *[F.avg(S.clean(F.col(c))).alias(f"site_mean_{c}") for c in cols])
    total = means.agg(F.sum("_rows")).first()[0] or 0
    joined = join_groups(df, means, site, "_rows", total)
    return joined.withColumns({c: F.col(c) - F.col(f"site_mean_{c}") for c in cols}).drop(
        *[f"site_mean_{c}" for c in cols])


def adaptive_preprocess(df: DataFrame, cols: Sequence[str], variance: float = 0.01) -> tuple[DataFrame, list[str]]:
    """Median impute, Yeo-Johnson on |skew| > 1, robust or standard scaling, then drop
    features with population variance <= ``variance``.  Other columns ride along."""
    advice = profile.preprocessing_advice(df, cols).first()
    out = impute(df, cols, "median").transform(df)
    skewed = [c for c in (advice["highly_skewed"] or "").split(",") if c]
    if skewed:
        out = fit_yeo_johnson(out, skewed).transform(out)
    out = scale(out, cols, "robust" if advice["has_outliers"] else "standard").transform(out)
    kept = variance_keep(out, cols, variance)
    return out.drop(*[c for c in cols if c not in kept]), kept


def variance_keep(df: DataFrame, cols: Sequence[str], threshold: float) -> list[str]:
    """Columns whose population variance exceeds the threshold."""
    st = _stats(df, cols, v=F.var_pop)
    kept = [c for c in cols if st[c]["v"] is not None and st[c]["v"] > threshold]
    if not kept:
        raise ValueError("no feature meets the variance threshold")
    return kept


def robust_vector_stats(df: DataFrame, vec: str, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Median and IQR per entry of a vector column (IQR 0 becomes 1)."""
    q = exact_quantiles(df, {str(i): F.col(vec)[i] for i in range(p)}, [0.25, 0.5, 0.75])
    med = np.array([q[str(i)][1] for i in range(p)])
    iqr = np.array([q[str(i)][2] - q[str(i)][0] for i in range(p)])
    return med, np.where(iqr == 0, 1.0, iqr)

