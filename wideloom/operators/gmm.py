"""Gaussian mixtures by expectation-maximisation.

E and M statistics of one round are a single pass that returns, per model, component
masses, weighted sums and weighted second moments.  A search over component counts and
restarts runs all its models in the same passes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions.vectors import matrix_column, scalar_column
from wideloom.operators.kmeans import Spec, fit_many, uniform
from wideloom.operators.reduce import gram
from wideloom.operators.rowsums import KeptRows, keep_smallest, sum_rows

COVARIANCES = ("full", "tied", "diag", "spherical")


@dataclass
class GaussianMixture:
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray  # (k, p, p) whatever the constraint
    covariance_type: str = "full"
    log_likelihood: float = float("-inf")  # mean per row
    rows: float = 0.0
    rounds: int = 0
    converged: bool = False
    history: tuple[float, ...] = ()
    start: int = 0  # the model uses the entries of a vector from here on

    def entries(self, x: np.ndarray) -> np.ndarray:
        return x[..., self.start:self.start + self.means.shape[1]]

    @property
    def k(self) -> int:
        return len(self.weights)

    def factors(self) -> tuple[np.ndarray, np.ndarray]:
        """Whitening matrix and log-determinant term of each component."""
        inv = np.stack([np.linalg.inv(np.linalg.cholesky(c)).T for c in self.covariances])
        p = self.means.shape[1]
        const = np.log(np.maximum(self.weights, 1e-300)) - 0.5 * p * math.log(2 * math.pi) + np.array(
            [np.log(np.diag(m)).sum() for m in inv])
        return inv, const

    def log_joint(self, x: np.ndarray, factors=None) -> np.ndarray:
        inv, const = factors or self.factors()
        x = self.entries(x)
        return np.stack([c - 0.5 * (((x - m) @ w) ** 2).sum(axis=1)
                         for m, w, c in zip(self.means, inv, const)], axis=1)

    def predict(self, vec: str | Column) -> Column:
        f = self.factors()
        return scalar_column(lambda x: self.log_joint(x, f).argmax(axis=1), vec, "int")

    def predict_proba(self, vec: str | Column) -> Column:
        f = self.factors()
        return matrix_column(lambda x: np.exp(_normalise(self.log_joint(x, f))[0]), vec)

    def score_samples(self, vec: str | Column) -> Column:
        f = self.factors()
        return scalar_column(lambda x: _normalise(self.log_joint(x, f))[1], vec)

    def transform(self, df: DataFrame, vec: str, out: str = "cluster") -> DataFrame:
        return df.withColumn(out, self.predict(vec))

    def parameters(self) -> float:
        p = self.means.shape[1]
        cov = {"full": self.k * p * (p + 1) / 2, "tied": p * (p + 1) / 2, "diag": self.k * p, "spherical": self.k}
        return self.k - 1 + self.k * p + cov[self.covariance_type]

    def criterion(self, df: DataFrame, vec: str, which: str = "bic") -> float:
        f = self.factors()
        n, ll = sum_rows(df, [vec], lambda x: (np.array([float(len(x))]),
                                               np.array([_normalise(self.log_joint(x, f))[1].sum()])), numbers=2)
        penalty = math.log(n[0]) if which == "bic" else 2.0
        return float(-2 * ll[0] + self.parameters() * penalty)


def _normalise(lj: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = lj.max(axis=1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(lj - top).sum(axis=1))
    return lj - total[:, None], total


def _m_step(n, nk, s1, s2, kind: str, reg: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    nk = nk + 10 * np.finfo(float).eps
    means = s1 / nk[:, None]
    cov = s2 / nk[:, None, None] - np.einsum("ki,kj->kij", means, means)
    p = means.shape[1]
    if kind == "tied":
        cov = np.repeat((cov * nk[:, None, None]).sum(0, keepdims=True) / nk.sum(), len(nk), axis=0)
    elif kind == "diag":
        cov = np.stack([np.diag(np.maximum(np.diag(c), 0)) for c in cov])
    elif kind == "spherical":
        cov = np.stack([np.eye(p) * max(np.trace(c) / p, 0) for c in cov])
    return nk / n, means, cov + reg * np.eye(p)


def fit_many_gmm(df: DataFrame, key: str, vec: str, models: dict[str, dict], max_iter: int = 100, tol: float = 1e-3,
                 reg_covar: float = 1e-6, init: str | np.ndarray = "kmeans") -> dict[str, GaussianMixture]:
    """Fit every entry ``name: {"k", "seed", "covariance_type", "start", "dims"}`` in shared passes; ``init``
    is "kmeans", "random" or the start means themselves.  A model uses ``dims`` entries from ``start`` on."""
    for m in models.values():
        if m.get("covariance_type", "full") not in COVARIANCES:
            raise ValueError(f"unknown covariance type {m['covariance_type']!r}")
    data = df.select(F.xxhash64(F.col(key)).alias("code"), F.col(vec).alias("v")).persist()
    rows = None
    try:
        g = gram(data, "v")
        origin, spread = g.mean, np.diag(g.scatter) / g.n + reg_covar
        views = {n: slice(m.get("start", 0), m.get("start", 0) + (m.get("dims") or len(origin) - m.get("start", 0)))
                 for n, m in models.items()}
        rows = KeptRows(data, ["code", "v"])
        if isinstance(init, np.ndarray):
            starts = {n: init for n in models}
        elif init == "kmeans":
            starts = {n: m.centers for n, m in fit_many(
                data, "code", "v", {n: Spec(m["k"], 1, m.get("dims"), m.get("seed", 42), start=m.get("start", 0))
                                    for n, m in models.items()}).items()}
        elif init == "random":
            starts = {n: c[:, views[n]] for n, c in _random_rows(rows, models, len(origin)).items()}
        else:
            raise ValueError(f"unknown initialisation {init!r}")
        fits = {n: GaussianMixture(np.full(m["k"], 1 / m["k"]), starts[n],
                                   np.repeat(np.diag(spread[views[n]])[None], m["k"], axis=0),
                                   m.get("covariance_type", "full"), rows=g.n, start=views[n].start) for n, m in models.items()}
        for _ in range(max_iter):
            active = [f for f in fits.values() if not f.converged]
            if not active:
                break
            factors = [f.factors() for f in active]

            def part(x, active=active, factors=factors):
                out, centered = [], x - origin
                for f, fac in zip(active, factors):
                    lr, ll = _normalise(f.log_joint(x, fac))
                    r, z = np.exp(lr), f.entries(centered)
                    out += [r.sum(0), r.T @ z, np.stack([(z * r[:, [j]]).T @ z for j in range(f.k)]),
                            np.array([ll.sum()])]
                return out

            flat = sum_rows(rows, ["v"], part, numbers=sum(f.k + f.means.size * (1 + f.means.shape[1]) + 1 for f in active))
            for i, f in enumerate(active):
                nk, s1, s2, ll = flat[4 * i:4 * i + 4]
                f.weights, f.means, f.covariances = _m_step(g.n, nk, s1, s2, f.covariance_type, reg_covar)
                f.means = f.means + f.entries(origin)
                now = float(ll[0]) / g.n
                f.converged = abs(now - f.log_likelihood) < tol
                f.log_likelihood, f.history, f.rounds = now, f.history + (now,), f.rounds + 1
        return fits
    finally:
        if rows is not None:
            rows.unpersist()
        data.unpersist()


def _random_rows(data: KeptRows, models: dict[str, dict], p: int) -> dict[str, np.ndarray]:
    """k distinct random rows per model, one pass per center."""
    picked = {n: np.zeros((0, p)) for n in models}
    for step in range(max(m["k"] for m in models.values())):
        todo = [n for n, m in models.items() if step < m["k"]]

        def part(c, x, todo=todo, step=step):
            scores, picks = np.full(len(todo), np.inf), np.zeros((len(todo), p))
            for i, n in enumerate(todo):
                s = uniform(c, models[n].get("seed", 42) * 1000 + step)
                for t in picked[n]:
                    s = np.where((x == t).all(axis=1), np.inf, s)
                j = int(s.argmin())
                scores[i], picks[i] = s[j], x[j]
            return scores, picks

        _, picks = sum_rows(data, ["code", "v"], part, keep_smallest, numbers=len(todo) * (p + 1))
        for n, row in zip(todo, picks):
            picked[n] = np.concatenate([picked[n], row[None]])
    return picked


def gmm(df: DataFrame, key: str, vec: str, k: int, covariance_type: str = "full", max_iter: int = 100,
        tol: float = 1e-3, reg_covar: float = 1e-6, seed: int = 42, init: str | np.ndarray = "kmeans", n_init: int = 1
        ) -> GaussianMixture:
    fits = fit_many_gmm(df, key, vec, {str(i): {"k": k, "seed": seed + 7 * i, "covariance_type": covariance_type}
                                       for i in range(n_init)}, max_iter, tol, reg_covar, init)
    return max(fits.values(), key=lambda f: f.log_likelihood)


def best_component_count(df: DataFrame, key: str, vec: str, max_components: int = 10, criterion: str = "bic",
                         n_runs: int = 3, max_iter: int = 100, covariance_type: str = "full", seed: int = 42
                         ) -> tuple[int, DataFrame, dict[int, GaussianMixture]]:
    """Component count 1..max with the lowest BIC or AIC over ``n_runs`` restarts each."""
    models = {f"{k}/{r}": {"k": k, "seed": seed + 13 * r, "covariance_type": covariance_type}
              for k in range(1, max_components + 1) for r in range(n_runs)}
    data = df.select(key, vec).persist()
    try:
        fits = fit_many_gmm(data, key, vec, models, max_iter)
        facs = {n: f.factors() for n, f in fits.items()}
        order = list(fits)

        def part(x):
            return [np.array([float(len(x))]),
                    np.array([_normalise(fits[n].log_joint(x, facs[n]))[1].sum() for n in order])]

        n, ll = sum_rows(data, [vec], part, numbers=1 + len(order))
    finally:
        data.unpersist()
    best: dict[int, tuple[float, GaussianMixture]] = {}
    for name, total in zip(order, ll):
        f = fits[name]
        s = float(-2 * total + f.parameters() * (math.log(n[0]) if criterion == "bic" else 2.0))
        if f.k not in best or s < best[f.k][0]:
            best[f.k] = (s, f)
    table = df.sparkSession.createDataFrame([(k, float(s)) for k, (s, _) in sorted(best.items())],
                                            "components int, score double")
    winner = min(best, key=lambda k: (best[k][0], k))
    return winner, table, {k: f for k, (_, f) in best.items()}


def top_two_binary(df: DataFrame, proba: str, out: str = "cluster") -> DataFrame:
    """1 where the most likely component is one of the two with the largest total
    responsibility, else 0."""
    mass = df.select(F.posexplode(proba).alias("j", "r")).groupBy("j").agg(F.sum("r").alias("mass"))
    top = [r["j"] for r in mass.orderBy(F.desc("mass"), "j").limit(2).collect()]
    label = (F.array_position(proba, F.array_max(proba)) - 1).cast("int")
    return df.withColumn(out, F.when(label.isin(top), 1).otherwise(0))
