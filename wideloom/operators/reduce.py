"""Dimensionality reduction and whitening on a vector column.

Rows are read once per fit by :func:`gram`; the (p x p) summary is decomposed on the
driver and comes back as one broadcast matrix multiply per Arrow batch.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions.samples import long_share, lowest
from wideloom.functions.vectors import matrix_column, width
from wideloom.operators.rowsums import KeptRows, sum_rows


@dataclass
class Gram:
    n: float
    mean: np.ndarray
    scatter: np.ndarray  # sum of (x - mean)(x - mean)'

    @property
    def cov(self) -> np.ndarray:
        return self.scatter / max(self.n - 1, 1)

    @property
    def second_moment(self) -> np.ndarray:
        return self.scatter + self.n * np.outer(self.mean, self.mean)

    @property
    def corr(self) -> np.ndarray:
        d = np.sqrt(np.diag(self.scatter))
        return self.scatter / np.outer(np.where(d > 0, d, 1), np.where(d > 0, d, 1))


def _head(df: DataFrame, vec: str, rows: int = 64) -> np.ndarray:
    """A few complete rows, only to shift sums by."""
    got = [r[0] for r in df.select(vec).take(rows)]
    if not got:
        raise ValueError("no rows to fit on")
    got = [v for v in got if v is not None and None not in v and not np.isnan(v).any()]
    if not got or len({len(v) for v in got}) > 1:
        raise ValueError("null, incomplete or unequal vectors: impute or filter them first")
    return np.array(got, dtype=np.float64)


def gram(df: DataFrame, vec: str, pre: Callable[[np.ndarray], np.ndarray] | None = None) -> Gram:
    """Count, mean and scatter matrix in one pass.

    Sums are taken about a pilot point (the mean of a few rows), so a large common offset
    does not cancel away the variance; the result does not depend on the pilot.
    ``pre`` is an optional batch transform applied inside the pass.
    """
    head = _head(df, vec)
    pilot = (pre(head) if pre else head).mean(axis=0)

    def part(x):
        z = (pre(x) if pre else x) - pilot
        return np.array([float(len(z))]), z.sum(axis=0), z.T @ z

    n, s, m2 = sum_rows(df, [vec], part, numbers=len(pilot) ** 2)
    n = float(n[0])
    return Gram(n, pilot + s / n, m2 - np.outer(s, s) / n)


def gram_diagonal(df: DataFrame, vec: str) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population variance per entry in one pass."""
    pilot = _head(df, vec).mean(axis=0)
    n, s, q = sum_rows(df, [vec], lambda x: (np.array([float(len(x))]), (x - pilot).sum(0), ((x - pilot) ** 2).sum(0)),
                       numbers=2 * len(pilot) + 1)
    m = s / n
    mean, var = pilot + m, np.maximum(q / n - m * m, 0)
    return mean, np.where(var <= (1e-14 * np.abs(mean)) ** 2, 0.0, var)


def gram_rows(df: DataFrame, vec: str) -> DataFrame:
    """Covariance matrix (upper triangle) as rows (i, j, cov)."""
    c = gram(df, vec).cov
    p = len(c)
    return df.sparkSession.createDataFrame(
        [(i, j, float(c[i, j])) for i in range(p) for j in range(i, p)], "i int, j int, cov double")


@dataclass
class Projection:
    """``(pre(x) - mean) @ matrix`` as a lazy column."""

    mean: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray | None = None  # variance of each output component
    ratio: np.ndarray | None = None
    pre: Callable[[np.ndarray], np.ndarray] | None = None

    def column(self, vec: str | Column) -> Column:
        mean, matrix, pre = self.mean, self.matrix, self.pre
        return matrix_column(lambda x: ((pre(x) if pre else x) - mean) @ matrix, vec)

    def transform(self, df: DataFrame, vec: str, out: str) -> DataFrame:
        return df.withColumn(out, self.column(vec))

    def first(self, k: int) -> Projection:
        """Components are nested: the fit for k is a prefix of the fit for more."""
        return Projection(self.mean, self.matrix[:, :k],
                          None if self.explained is None else self.explained[:k],
                          None if self.ratio is None else self.ratio[:k], self.pre)


def _signed(vectors: np.ndarray) -> np.ndarray:
    """Fix the sign of each column: its largest-magnitude entry is positive."""
    top = np.abs(vectors).argmax(axis=0)
    s = np.sign(vectors[top, np.arange(vectors.shape[1])])
    return vectors * np.where(s == 0, 1, s)


def _eigen(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in descending order, clamped at zero, with signed eigenvectors."""
    w, v = np.linalg.eigh((m + m.T) / 2)
    order = np.argsort(w)[::-1]
    return np.maximum(w[order], 0.0), _signed(v[:, order])


def pca_from_gram(g: Gram, k: int | float | None, whiten: bool = False, pre=None) -> Projection:
    """``k``: a count, a variance share below one, or None for all components."""
    w, v = _eigen(g.cov)
    ratio = w / w.sum() if w.sum() > 0 else np.zeros_like(w)
    if k is None:
        k = min(len(w), int(g.n))
    elif isinstance(k, float) and k < 1:
        k = components_for(ratio, k)
    k = int(min(k, len(w)))
    m = v[:, :k]
    if whiten:
        m = m / np.sqrt(np.maximum(w[:k], np.finfo(float).eps * max(w[0], 1e-300)))
    return Projection(g.mean, m, w[:k], ratio[:k], pre)


def components_for(ratio: np.ndarray, share: float) -> int:
    """Smallest number of components whose cumulative variance exceeds the share; all of
    them when it is never reached."""
    over = np.flatnonzero(np.cumsum(ratio) > share)
    return int(over[0]) + 1 if len(over) else len(ratio)


def pca(df: DataFrame, vec: str, k: int | float | None = None, whiten: bool = False) -> Projection:
    return pca_from_gram(gram(df, vec), k, whiten)


def double_pca(df: DataFrame, vec: str, k: int) -> Projection:
    """Full PCA, then PCA to k: scores already have a diagonal covariance, so the second
    step only keeps the first k of them."""
    return pca(df, vec, None).first(k)


def explained_variance(model: Projection, df: DataFrame) -> DataFrame:
    cum = np.cumsum(model.ratio)
    return df.sparkSession.createDataFrame(
        [(i + 1, float(r), float(c), bool(c >= 0.8), bool(c >= 0.9))
         for i, (r, c) in enumerate(zip(model.ratio, cum))],
        "component int, ratio double, cumulative double, reaches_80 boolean, reaches_90 boolean")


def truncated_svd(df: DataFrame, vec: str, k: int) -> Projection:
    """Right singular vectors of the uncentred matrix; ``ratio`` is the variance of the
    scores over the total variance of the input."""
    g = gram(df, vec)
    _, v = _eigen(g.second_moment)
    m = v[:, :k]
    var = np.diag(m.T @ (g.scatter / g.n) @ m)
    total = np.trace(g.scatter) / g.n
    return Projection(np.zeros_like(g.mean), m, var, var / total if total > 0 else var * 0)


def random_projection(df: DataFrame, vec: str, k: int, seed: int = 42) -> Projection:
    p = width(df, vec)
    m = np.random.default_rng(seed).normal(0.0, 1.0 / np.sqrt(k), size=(p, k))
    return Projection(np.zeros(p), m)


# ---- polynomial features inside the pass -------------------------------------------

def poly_terms(p: int, degree: int = 2, interaction_only: bool = False) -> list[tuple[int, ...]]:
    """Index tuples in graded lexicographic order, no constant term."""
    from itertools import combinations, combinations_with_replacement as cwr

    pick = combinations if interaction_only else cwr
    return [t for d in range(1, degree + 1) for t in pick(range(p), d)]


def poly_expand(p: int, degree: int = 2, interaction_only: bool = False) -> Callable[[np.ndarray], np.ndarray]:
    terms = poly_terms(p, degree, interaction_only)
    by_degree = [np.array([t for t in terms if len(t) == d]).reshape(-1, d) for d in range(1, degree + 1)]

    def expand(x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.prod(x[:, ix], axis=2) for ix in by_degree if len(ix)], axis=1)

    return expand


def polynomial_pca(df: DataFrame, vec: str, k: int, degree: int = 2, interaction_only: bool = False) -> Projection:
    """PCA of polynomial features that only ever exist batch by batch."""
    pre = poly_expand(width(df, vec), degree, interaction_only)
    return pca_from_gram(gram(df, vec, pre), k, pre=pre)


TERMS = 1 << 14  # polynomial terms expanded at once
_term_index: dict[tuple, np.ndarray] = {}


def _index_of_terms(p: int, degree: int, interaction_only: bool) -> np.ndarray:
    """The factors of every term, padded with ``p`` (a factor of one); kept once per worker."""
    name = (p, degree, interaction_only)
    if name not in _term_index:
        if degree == 2:
            a, b = np.triu_indices(p, 1 if interaction_only else 0)
            out = np.full((p + len(a), 2), p, np.int32)
            out[:p, 0], out[p:, 0], out[p:, 1] = np.arange(p), a, b
        else:
            terms = poly_terms(p, degree, interaction_only)
            out = np.full((len(terms), degree), p, np.int32)
            for i, t in enumerate(terms):
                out[i, :len(t)] = t
        _term_index[name] = out
    return _term_index[name]


class _TermBlocks:
    """Polynomial terms of some rows, ``TERMS`` columns at a time."""

    def __init__(self, p: int, degree: int, interaction_only: bool):
        self.shape = p, degree, interaction_only

    @property
    def index(self) -> np.ndarray:
        return _index_of_terms(*self.shape)

    def of(self, x: np.ndarray):
        one = np.concatenate([x, np.ones((len(x), 1))], axis=1)
        for i in range(0, len(self.index), TERMS):
            factors = self.index[i:i + TERMS]
            out = one[:, factors[:, 0]]
            for c in range(1, factors.shape[1]):
                out = out * one[:, factors[:, c]]
            yield i, out

    def times(self, x: np.ndarray, matrix: Callable[[int, int], np.ndarray]) -> np.ndarray:
        total = None
        for i, block in self.of(x):
            part = block @ matrix(i, i + block.shape[1])
            total = part if total is None else total + part
        return total


class PolynomialSketch(Projection):
    """A projection of polynomial terms that are expanded a block of columns at a time."""

    def column(self, vec: str | Column) -> Column:
        mean, matrix, terms = self.mean, self.matrix, self.pre
        shift = mean @ matrix
        return matrix_column(lambda x: np.concatenate([
            terms.times(x[i:i + 256], lambda a, b: matrix[a:b]) - shift for i in range(0, len(x), 256)]), vec)


def sketched_polynomial_pca(df: DataFrame, vec: str, k: int, degree: int = 2, interaction_only: bool = False, extra: int = 10,
                            passes: int = 2, seed: int = 42) -> PolynomialSketch:
    """PCA of polynomial features by a random range finder, without their Gram matrix.

    Each of ``passes`` passes over the rows multiplies the centered expansion, transposed, with the
    expansion times k + ``extra`` directions: numbers of terms times directions, in pieces.  A last pass
    solves for the components inside.  Rows are expanded a block of columns at a time.
    """
    p = width(df, vec)
    terms = _TermBlocks(p, degree, interaction_only)
    size, wide = len(terms.index), k + extra

    def drawn(a: int, b: int) -> np.ndarray:  # the same numbers in every task, without sending them
        return np.concatenate([np.random.default_rng([seed, i]).standard_normal((min(i + TERMS, size) - i, wide))
                               for i in range(a - a % TERMS, b, TERMS)])[a % TERMS:][:b - a]

    basis = None
    n, mean = 0.0, np.zeros(size)
    for _ in range(passes):
        factor = drawn if basis is None else lambda a, b, q=basis: q[a:b]

        def part(x, factor=factor):
            z, total = np.zeros((size, wide)), np.zeros(size)
            flat = np.zeros(wide)
            for r in range(0, len(x), 256):
                y = terms.times(x[r:r + 256], factor)
                flat += y.sum(0)
                for i, block in terms.of(x[r:r + 256]):
                    z[i:i + block.shape[1]] += block.T @ y
                    total[i:i + block.shape[1]] += block.sum(0)
            return z, total, flat, np.array([float(len(x))])

        z, total, flat, rows = sum_rows(df, [vec], part, numbers=size * (wide + 1))
        n, mean = float(rows[0]), total / rows[0]
        basis = np.linalg.qr(z - np.outer(mean, flat))[0]
    shift = mean @ basis

    def last(x, q=basis):
        square, spread = np.zeros((q.shape[1], q.shape[1])), 0.0
        for r in range(0, len(x), 256):
            y = terms.times(x[r:r + 256], lambda a, b: q[a:b]) - shift
            square += y.T @ y
            for i, block in terms.of(x[r:r + 256]):
                spread += float(((block - mean[i:i + block.shape[1]]) ** 2).sum())
        return square, np.array([spread])

    square, spread = sum_rows(df, [vec], last, numbers=wide * wide + 1)
    w, u = _eigen(square / max(n - 1, 1))
    whole = float(spread[0]) / max(n - 1, 1)
    matrix = _signed((basis @ u)[:, :k])
    return PolynomialSketch(mean, matrix, w[:k], w[:k] / whole if whole > 0 else np.zeros(k), terms)


# ---- whitening ------------------------------------------------------------------------

def zca_matrix(cov: np.ndarray, eps: float = 1e-6) -> np.ndarray:
    w, v = _eigen(cov)
    return (v / np.sqrt(w + eps)) @ v.T


def cholesky_matrix(cov: np.ndarray, reg: float = 1e-6) -> np.ndarray:
    """``L^-T`` with lower L, which makes the covariance the identity."""
    low = np.linalg.cholesky(cov + reg * np.eye(len(cov)))
    return np.linalg.inv(low).T


def mahalanobis_matrix(cov: np.ndarray, reg: float = 1e-6, floor: float = 1e-6) -> np.ndarray:
    w, v = _eigen(cov + reg * np.eye(len(cov)))
    return (v / np.sqrt(np.maximum(w, floor))) @ v.T


def adaptive_matrix(cov: np.ndarray, alpha: float = 1.0, eps: float = 1e-6) -> np.ndarray:
    w, v = _eigen(cov)
    return v * (w ** (1 - alpha) / np.sqrt(w + eps))


def hybrid_matrix(cov: np.ndarray, zca_weight: float = 0.5, alpha: float = 0.7, eps: float = 1e-6) -> np.ndarray:
    w, v = _eigen(cov)
    w = np.maximum(w, eps)
    zca = (v / np.sqrt(w)) @ v.T
    adaptive = v * (w ** (1 - alpha) / np.sqrt(w))
    t = min(max(zca_weight, 0.0), 1.0)
    return t * zca + (1 - t) * adaptive


WHITENERS = {"zca": zca_matrix, "cholesky": cholesky_matrix, "mahalanobis": mahalanobis_matrix,
             "adaptive": adaptive_matrix, "hybrid": hybrid_matrix}


def whiten_from_gram(g: Gram, method: str, k: int | None = None, **params) -> Projection:
    """Whitening, then PCA to k composed into one matrix.

    The covariance of the whitened data is ``W' C W``, so the second PCA needs no second
    pass.  Adaptive whitening keeps its first k columns instead.
    """
    if method not in WHITENERS:
        raise ValueError(f"unknown whitening {method!r}")
    m = whole = WHITENERS[method](g.cov, **params)
    p = m.shape[1]
    if k is not None and method == "adaptive":
        m = m[:, :k]
    elif k is not None and not (method == "hybrid" and k >= p):
        _, v = _eigen(m.T @ g.cov @ m)
        m = m @ v[:, :k]
    var = np.diag(m.T @ g.cov @ m)
    total = np.trace(whole.T @ g.cov @ whole)
    return Projection(g.mean, m, var, var / total if total > 0 else var * 0)


def whiten(df: DataFrame, vec: str, method: str, k: int | None = None, **params) -> Projection:
    return whiten_from_gram(gram(df, vec), method, k, **params)


def compare_whitening(df: DataFrame, vec: str, k: int = 2, alphas: Sequence[float] = (0.3, 0.7, 1.0),
                      weights: Sequence[float] = (0.3, 0.5, 0.7)) -> DataFrame:
    """Covariance of every method's output as rows (method, i, j, cov), measured on the
    transformed rows in one pass."""
    g = gram(df, vec)
    models = {"pca": pca_from_gram(g, k), "pca_whiten": pca_from_gram(g, k, True),
              **{m: whiten_from_gram(g, m, k) for m in ("zca", "cholesky", "mahalanobis")},
              **{f"adaptive_{a}": whiten_from_gram(g, "adaptive", k, alpha=a) for a in alphas},
              **{f"hybrid_{w}": whiten_from_gram(g, "hybrid", k, zca_weight=w) for w in weights}}
    stack = np.concatenate([m.matrix for m in models.values()], axis=1)
    mean = g.mean
    out = gram(df, vec, lambda x: (x - mean) @ stack).cov
    rows, at = [], 0
    for name, m in models.items():
        w = m.matrix.shape[1]
        rows += [(name, i, j, float(out[at + i, at + j])) for i in range(w) for j in range(w)]
        at += w
    return df.sparkSession.createDataFrame(rows, "method string, i int, j int, cov double")


# ---- kernel PCA -------------------------------------------------------------------------

def kernel_matrix(x: np.ndarray, y: np.ndarray, kernel: str, gamma: float, degree: int = 3, coef0: float = 1.0):
    if kernel == "linear":
        return x @ y.T
    if kernel == "poly":
        return (gamma * (x @ y.T) + coef0) ** degree
    if kernel == "sigmoid":
        return np.tanh(gamma * (x @ y.T) + coef0)
    if kernel == "cosine":
        nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
        return (x / np.where(nx > 0, nx, 1)[:, None]) @ (y / np.where(ny > 0, ny, 1)[:, None]).T
    if kernel == "rbf":
        d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
        return np.exp(-gamma * np.maximum(d, 0))
    raise ValueError(f"unknown kernel {kernel!r}")


@dataclass
class KernelPCA(Projection):
    """Kernel PCA as a PCA of explicit features of every row."""

    kernel: str = "rbf"
    gamma: float = 1.0
    landmarks: np.ndarray | None = None  # None: the kernel has exact features of its own


def landmarks(df: DataFrame, key: str, vec: str, m: int, seed: int = 42) -> np.ndarray:
    """Up to ``m`` rows, the lowest by hashed key: the same rows on every run."""
    code = F.xxhash64(F.col(key), F.lit(seed))
    data = df.where(F.col(vec).isNotNull()).select(key, vec)
    rows = lowest(data, long_share(code), [code, key], m).select(vec).collect()
    return np.array([r[0] for r in rows], dtype=np.float64)


def _unit_rows(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1)
    return x / np.where(norm > 0, norm, 1)[:, None]


def kernel_pca(df: DataFrame, key: str, vec: str, k: int, kernel: str = "rbf", gamma: float | None = None,
               max_landmarks: int = 1000, seed: int = 42) -> KernelPCA:
    """Kernel PCA over all rows.

    The linear and cosine kernels are inner products of the rows and of the unit rows, so a Gram
    matrix of those is exact.  The other kernels get Nystrom features ``k(x, landmarks) K^(-1/2)``,
    which reproduce the kernel among the landmarks (all of it when every row is one);
    ``max_landmarks`` is their number, means and components come from all rows.
    """
    if kernel in ("linear", "cosine"):
        pre, lm, gamma = (_unit_rows if kernel == "cosine" else None), None, 1.0 if gamma is None else gamma
    else:
        lm = np.unique(landmarks(df, key, vec, max_landmarks, seed), axis=0)
        if not lm.size:
            raise ValueError("no rows to fit on")
        gamma = 1.0 / lm.shape[1] if gamma is None else gamma
        w, v = np.linalg.eigh(kernel_matrix(lm, lm, kernel, gamma))
        on = w > 1e-10 * max(w.max(), 1e-300)  # the sigmoid kernel has negative directions: left out
        root = v[:, on] / np.sqrt(w[on])
        pre = lambda x: kernel_matrix(x, lm, kernel, gamma) @ root
    g = gram(df, vec, pre)
    w, v = _eigen(g.scatter)
    k = min(k, int((w > 1e-10 * max(w[0], 1e-300)).sum()))
    return KernelPCA(g.mean, v[:, :k], w[:k], None, pre, kernel, gamma, lm)


# ---- ICA, NMF, dictionary learning --------------------------------------------------------

@dataclass
class ICA(Projection):
    rounds: int = 0
    converged: bool = False


def ica(df: DataFrame, vec: str, k: int, max_iter: int = 200, tol: float = 1e-4, seed: int = 42) -> ICA:
    """FastICA with the log-cosh contrast and symmetric decorrelation; one aggregation per
    round, unit-variance sources."""
    return ica_many(df, vec, [k], max_iter, tol, seed)[k]


def ica_many(df: DataFrame, vec: str, counts: Sequence[int], max_iter: int = 200, tol: float = 1e-4, seed: int = 42
             ) -> dict[int, ICA]:
    """One ICA per number of sources; a pass serves every one that has not converged."""
    g = gram(df, vec)

    def decorrelate(w):
        u, _, vt = np.linalg.svd(w)
        return u @ vt

    start, weights = {}, {}
    for c in counts:
        start[c] = pca_from_gram(g, c, True).matrix * np.sqrt(g.n / max(g.n - 1, 1))
        k = start[c].shape[1]
        weights[c] = decorrelate(np.random.default_rng(seed).normal(size=(k, k)))
    mean, rounds, change = g.mean, dict.fromkeys(counts, 0), dict.fromkeys(counts, np.inf)
    data = KeptRows(df, [vec])
    try:
        for _ in range(max_iter):
            active = [c for c in start if change[c] >= tol]
            if not active:
                break
            fits = [(start[c], weights[c]) for c in active]

            def part(x, fits=fits):
                out, x = [], x - mean
                for m, w in fits:
                    z = x @ m
                    t = np.tanh(z @ w.T)
                    out += [t.T @ z, (1 - t * t).sum(axis=0)]
                return out

            flat = sum_rows(data, [vec], part, numbers=sum(w.size + len(w) for _, w in fits))
            for i, c in enumerate(active):
                gz, gp = flat[2 * i:2 * i + 2]
                new = decorrelate(gz / g.n - (gp / g.n)[:, None] * weights[c])
                change[c] = np.max(np.abs(np.abs(np.einsum("ij,ij->i", new, weights[c])) - 1))
                weights[c], rounds[c] = new, rounds[c] + 1
    finally:
        data.unpersist()
    late = [c for c in start if not change[c] < tol]
    for _ in late:
        warnings.warn(f"ICA did not converge in {max_iter} rounds", stacklevel=2)
    return {c: ICA(mean, start[c] @ weights[c].T, rounds=rounds[c], converged=c not in late) for c in start}


def _nonneg_codes(x: np.ndarray, h: np.ndarray, sweeps: int) -> np.ndarray:
    """Row-wise non-negative least squares by coordinate descent."""
    gram_h, xh = h @ h.T, x @ h.T
    w = np.maximum(xh / np.maximum(np.diag(gram_h), 1e-12) / len(h), 0)
    for _ in range(sweeps):
        for j in range(len(h)):
            step = (xh[:, j] - w @ gram_h[:, j]) / max(gram_h[j, j], 1e-12)
            w[:, j] = np.maximum(w[:, j] + step, 0)
    return w


@dataclass
class Factorisation:
    components: np.ndarray
    losses: list[float]
    codes: Callable[[np.ndarray], np.ndarray]
    converged: bool = False

    def transform(self, df: DataFrame, vec: str, out: str) -> DataFrame:
        return df.withColumn(out, matrix_column(self.codes, vec))


def nmf(df: DataFrame, vec: str, k: int, max_iter: int = 200, tol: float = 1e-4, seed: int = 42, sweeps: int = 30,
        init: np.ndarray | None = None) -> Factorisation:
    """Non-negative factorisation of max(0, X).

    Row weights are re-solved from the broadcast components in every pass, so no per-row
    state is kept between rounds; only W'X, W'W and the loss are aggregated.
    """
    total, n, sq = sum_rows(df, [vec], lambda x: (np.maximum(x, 0).sum(axis=0), np.array([float(len(x))]),
                                                  np.array([(np.maximum(x, 0) ** 2).sum()])), numbers=1000)
    level = np.sqrt(max(total.mean() / n[0], 1e-12) / k)
    h = np.abs(np.random.default_rng(seed).normal(size=(k, len(total)))) * level + 1e-6 if init is None else np.array(init, float)
    losses: list[float] = []
    converged = False
    for _ in range(max_iter):
        def part(x, h=h):
            x = np.maximum(x, 0)
            w = _nonneg_codes(x, h, sweeps)
            return w.T @ x, w.T @ w, np.array([((x - w @ h) ** 2).sum()])

        wx, ww, loss = sum_rows(df, [vec], part, numbers=k * (k + len(total)) + 1)
        losses.append(float(loss[0]))
        converged = len(losses) > 1 and losses[-2] - losses[-1] <= tol * max(float(sq[0]), 1e-300)
        if converged:
            break
        new = h.copy()
        for _ in range(10):
            for j in range(k):
                if ww[j, j] > 1e-12:
                    new[j] = np.maximum(new[j] + (wx[j] - ww[j] @ new) / ww[j, j], 0)
        h = new
    final = h
    if not converged:
        warnings.warn(f"NMF did not converge in {max_iter} rounds", stacklevel=2)
    return Factorisation(final, losses, lambda x: _nonneg_codes(np.maximum(x, 0), final, sweeps), converged)


def _sparse_codes(x: np.ndarray, d: np.ndarray, alpha: float, sweeps: int) -> np.ndarray:
    """Row-wise lasso (1/2 |x - aD|^2 + alpha |a|_1) by coordinate descent."""
    g, xd = d @ d.T, x @ d.T
    a = np.zeros((len(x), len(d)))
    for _ in range(sweeps):
        for j in range(len(d)):
            r = xd[:, j] - a @ g[:, j] + a[:, j] * g[j, j]
            a[:, j] = np.sign(r) * np.maximum(np.abs(r) - alpha, 0) / max(g[j, j], 1e-12)
    return a


def dictionary_learning(df: DataFrame, vec: str, k: int, alpha: float = 1.0, max_iter: int = 200, seed: int = 42,
                        sweeps: int = 30, tol: float = 1e-4, init: np.ndarray | None = None) -> Factorisation:
    """Sparse coding of the data shifted to be non-negative; unit-norm atoms.

    Each round codes every row against the broadcast atoms and aggregates A'A and A'X.  It ends
    when a round lowers the loss by less than ``tol`` of it.
    """
    low = min(0.0, float(df.agg(F.min(F.array_min(vec))).first()[0]))
    mean, n = sum_rows(df, [vec], lambda x: ((x - low).sum(axis=0), np.array([float(len(x))])), numbers=1000)
    rng = np.random.default_rng(seed)
    d = np.maximum(mean / n[0], 1e-9) * rng.uniform(0.5, 1.5, size=(k, len(mean)))
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    d = d if init is None else np.array(init, float)
    losses: list[float] = []
    converged = False
    for _ in range(max_iter):
        def part(x, d=d):
            x = x - low
            a = _sparse_codes(x, d, alpha, sweeps)
            return a.T @ a, a.T @ x, np.array([0.5 * ((x - a @ d) ** 2).sum() + alpha * np.abs(a).sum()])

        aa, ax, loss = sum_rows(df, [vec], part, numbers=k * (k + len(mean)) + 1)
        losses.append(float(loss[0]))
        converged = len(losses) > 1 and losses[-2] - losses[-1] <= tol * losses[-2]
        if converged:
            break
        new = d.copy()
        for _ in range(5):
            for j in range(k):
                if aa[j, j] > 1e-12:
                    atom = new[j] + (ax[j] - aa[j] @ new) / aa[j, j]
                    new[j] = atom / max(np.linalg.norm(atom), 1.0)
        d = new
    final = d
    if not converged:
        warnings.warn(f"dictionary learning did not converge in {max_iter} rounds", stacklevel=2)
    return Factorisation(final, losses, lambda x: _sparse_codes(x - low, final, alpha, sweeps), converged)


# ---- dispatch ---------------------------------------------------------------------------------

REDUCTIONS = ("pca", "kernel_pca", "polynomial_pca", "ica", "truncated_svd")


def reduce_by(df: DataFrame, key: str, vec: str, method: str = "pca", k: int | Sequence[int] | None = None,
              rows: int | None = None):
    """Fit one of ``REDUCTIONS``; k defaults to min(20, n / 5, p).  Unknown names raise.  Several counts give
    a model for each."""
    if isinstance(k, Sequence):
        if method == "ica":
            return ica_many(df, vec, k, max_iter=1000, tol=0.01)
        return {c: reduce_by(df, key, vec, method, c, rows) for c in k}
    if k is None:
        k = min(20, max(1, (df.count() if rows is None else rows) // 5), width(df, vec))
    if method == "pca":
        return pca(df, vec, k)
    if method == "kernel_pca":
        return kernel_pca(df, key, vec, k, "rbf", 0.01)
    if method == "polynomial_pca":
        return polynomial_pca(df, vec, k, 2, True)
    if method == "ica":
        return ica(df, vec, k, max_iter=1000, tol=0.01)
    if method == "truncated_svd":
        return truncated_svd(df, vec, k)
    raise ValueError(f"unknown reduction {method!r}")
