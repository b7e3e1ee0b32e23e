"""K-means and its enhanced variants.

All restarts, all k and all nested component counts of a sweep are fitted together: one
scan of the rows per round serves every run that has not converged yet.  A task returns
(clusters x features) sums per run; rows stay where they are.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions.moments import class_moments, moments_long
from wideloom.functions.vectors import literal_vector, scalar_column, sq_dist
from wideloom.operators.quantiles import exact_quantiles
from wideloom.operators.rowsums import KeptRows, keep_smallest, sum_rows

METRICS = ("euclidean", "manhattan", "cosine", "rbf")


def distances(x: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """(rows x centers) distances."""
    if metric == "manhattan":
        return np.stack([np.abs(x - cj).sum(axis=1) for cj in c], axis=1)
    if metric == "cosine":
        nx, nc = np.linalg.norm(x, axis=1), np.linalg.norm(c, axis=1)
        return 1 - (x @ c.T) / np.maximum(np.outer(nx, nc), 1e-300)
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    o = c.mean(axis=0)  # shared origin: keeps the expanded square accurate
    x, c = x - o, c - o
    d = np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * (x @ c.T), 0)
    return np.sqrt(d) if metric == "euclidean" else 1 - np.exp(-d)


def cost(d: np.ndarray, metric: str) -> np.ndarray:
    return d * d if metric == "euclidean" else d


def uniform(code: np.ndarray, seed: int) -> np.ndarray:
    """Uniform (0, 1) numbers from hashed row keys: the same row draws the same number on
    every attempt and every executor (splitmix64)."""
    z = code.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


@dataclass
class Spec:
    """One clustering to fit; it uses ``dims`` entries of the vector from ``start`` on."""

    k: int
    n_init: int = 10
    dims: int | None = None
    seed: int = 42
    metric: str = "euclidean"
    weights: Sequence[float] | None = None
    enhanced: bool = False  # median update, momentum, decaying step, early stop
    momentum: float = 0.1
    outlier_handling: bool = True
    init: np.ndarray | None = None
    start: int = 0


@dataclass
class KMeansModel:
    centers: np.ndarray
    metric: str = "euclidean"
    weights: np.ndarray | None = None
    inertia: float = float("nan")
    rounds: int = 0
    converged: bool = True
    start: int = 0

    @property
    def dims(self) -> int:
        return self.centers.shape[1]

    def entries(self, x: np.ndarray) -> np.ndarray:
        return x[:, self.start:self.start + self.dims]

    def _view(self, x: np.ndarray) -> np.ndarray:
        x = self.entries(x)
        return x if self.weights is None else x * self.weights

    def _centers(self) -> np.ndarray:
        return self.centers if self.weights is None else self.centers * self.weights

    def distances(self, x: np.ndarray) -> np.ndarray:
        return distances(self._view(x), self._centers(), self.metric)

    def column(self, vec: str | Column) -> Column:
        return scalar_column(lambda x: self.distances(x).argmin(axis=1), vec, "int")

    def transform(self, df: DataFrame, vec: str, out: str = "cluster") -> DataFrame:
        return df.withColumn(out, self.column(vec))

    def total_cost(self, df: DataFrame, vec: str) -> float:
        def part(x):
            return [np.array([cost(self.distances(x).min(axis=1), self.metric).sum()])]

        return float(sum_rows(df, [vec], part, numbers=1)[0][0])


@dataclass
class _Run:
    name: str
    spec: Spec
    seed: int
    centers: np.ndarray
    weights: np.ndarray | None
    velocity: np.ndarray | None = None
    prev_cost: float = float("inf")
    stale: int = 0
    rounds: int = 0
    done: bool = False
    inertia: float = float("inf")
    stats: dict = field(default_factory=dict)

    def model(self) -> KMeansModel:
        return KMeansModel(self.centers, self.spec.metric, self.weights, self.inertia, self.rounds, self.done,
                           self.spec.start)

    def entries(self, x: np.ndarray) -> np.ndarray:
        """The entries of the vectors (along the last axis) that the run uses."""
        return x[..., self.spec.start:self.spec.start + self.centers.shape[1]]


def _views(runs: Sequence[_Run]) -> list[KMeansModel]:
    return [r.model() for r in runs]


def _seed_centers(df, code, vec, runs: list[_Run], p: int) -> None:
    """k-means++ for every run at once.

    Sampling a row with probability proportional to w is the minimum of Exp(1) / w over
    rows, so each new center is one mergeable pass.  The first center of an enhanced run
    comes from rows within three standard deviations.
    """
    bounds = {}
    if any(r.spec.enhanced and r.spec.outlier_handling for r in runs):
        n, s, q = sum_rows(df, [vec], lambda x: (np.array([float(len(x))]), x.sum(0), (x * x).sum(0)), numbers=2 * p + 1)
        mean = s / n
        bounds = {"mean": mean, "sd": np.sqrt(np.maximum(q / n - mean * mean, 0))}
    fresh = [r for r in runs if r.spec.init is None]
    few = [r for r in fresh if r.spec.k <= SEED_ROUNDS + 2]
    many = [r for r in fresh if r.spec.k > SEED_ROUNDS + 2]
    for step in range(max([r.spec.k for r in few] + [1 if many else 0], default=0)):
        todo = [r for r in few if step < r.spec.k] + (many if step == 0 else [])
        models, seeds = _views(todo), [r.seed * 1000 + step for r in todo]
        inlier = [r.spec.enhanced and r.spec.outlier_handling for r in todo]

        def part(c, x, models=models, seeds=seeds, inlier=inlier):
            scores, picks = np.full(len(models), np.inf), np.zeros((len(models), p))
            for i, m in enumerate(models):
                e = -np.log(uniform(c, seeds[i]))
                if len(m.centers):
                    w = m.distances(x).min(axis=1) ** 2
                elif inlier[i]:
                    far = (np.abs(x - bounds["mean"]) > 3 * bounds["sd"]).any(axis=1)
                    w = np.where(far, 1e-9, 1.0)  # outliers only if nothing else is left
                else:
                    w = np.ones(len(x))
                s = np.where(w > 0, e / np.maximum(w, 1e-300), np.finfo(float).max * (0.5 + 0.5 * e / (1 + e)))
                j = int(s.argmin())
                scores[i], picks[i] = s[j], x[j]
            return scores, picks

        _, picks = sum_rows(df, [code, vec], part, keep_smallest, numbers=len(todo) * (p + 1))
        for r, pick in zip(todo, picks):
            r.centers = np.concatenate([r.centers, r.entries(pick)[None]])
    if many:
        _seed_in_rounds(df, code, vec, many, p)


SEED_ROUNDS = 4


def _seed_in_rounds(df, code, vec, runs: list[_Run], p: int) -> None:
    """k-means|| (Bahmani et al. 2012): the number of passes does not depend on k.

    A round draws 2k rows per run with probability proportional to their squared distance to the
    candidates so far (the smallest Exp(1) / w, which merges across tasks).  One more pass weighs the
    candidates by the rows nearest to them; weighted k-means++ on those few gives the start.
    """
    most = 2 * max(r.spec.k for r in runs)

    def lowest(a, b):
        s = np.concatenate([a[0], b[0]], axis=1)
        at = np.argsort(s, axis=1, kind="stable")[:, :most]
        rows = np.concatenate([a[1], b[1]], axis=1)
        return np.take_along_axis(s, at, axis=1), np.take_along_axis(rows, at[:, :, None], axis=1)

    for step in range(SEED_ROUNDS):
        models = _views(runs)

        def part(c, x, models=models, step=step):
            scores, picks = np.full((len(models), most), np.inf), np.zeros((len(models), most, p))
            for i, m in enumerate(models):
                w = m.distances(x).min(axis=1) ** 2
                e = -np.log(uniform(c, runs[i].seed * 1000 + 500 + step))
                s = np.where(w > 0, e / np.maximum(w, 1e-300), np.inf)
                at = np.argsort(s, kind="stable")[:2 * runs[i].spec.k]
                scores[i, :len(at)], picks[i, :len(at)] = s[at], x[at]
            return scores, picks

        scores, picks = sum_rows(df, [code, vec], part, lowest, numbers=len(runs) * most * (p + 1))
        for r, s, rows in zip(runs, scores, picks):
            ok = np.isfinite(s[:2 * r.spec.k])
            r.centers = np.concatenate([r.centers, r.entries(rows[:2 * r.spec.k][ok])])
    models = _views(runs)
    weights = sum_rows(df, [vec], lambda x: [np.bincount(m.distances(x).argmin(axis=1), minlength=len(m.centers)).astype(float)
                                             for m in models], numbers=sum(len(m.centers) for m in models))
    for r, m, w in zip(runs, models, weights):
        r.centers = _weighted_start(m, w, r.spec.k, np.random.default_rng(r.seed))


def _weighted_start(m: KMeansModel, w: np.ndarray, k: int, rng) -> np.ndarray:
    """k-means++ and a few Lloyd rounds on weighted candidates.  With fewer than k different
    candidates the rest repeats some, as too few distinct rows would."""
    c = m.centers
    chosen = [int(rng.choice(len(c), p=w / w.sum()))]
    while len(chosen) < k:
        near = KMeansModel(c[chosen], m.metric, m.weights).distances(c).min(axis=1) ** 2 * w
        chosen.append(int(rng.choice(len(c), p=near / near.sum())) if near.sum() > 0 else int(rng.integers(len(c))))
    start = c[chosen].copy()
    for _ in range(10):
        at = KMeansModel(start, m.metric, m.weights).distances(c).argmin(axis=1)
        for j in np.unique(at[w > 0]):
            on = at == j
            if w[on].sum() > 0:
                start[j] = np.average(c[on], axis=0, weights=w[on])
    return start


NARROW = 32  # histogram cells of a narrowing pass: few values are left, so its summary stays small


def _uses_median(r: _Run) -> bool:
    return r.spec.enhanced and r.spec.outlier_handling


def _bins(runs: Sequence[_Run]) -> int:
    """Histogram width that keeps the assignment pass's summary within about 200,000 numbers."""
    cells = sum(r.centers.size for r in runs if _uses_median(r))
    return int(np.clip(200_000 // max(cells, 1), NARROW, 1024))


def _histogram(v, a, k, lo, w, bins):
    """Per (cluster, feature): rows below ``lo`` and counts in ``bins`` cells of [lo, lo + w]."""
    p = v.shape[1]
    below = np.zeros((k, p))
    np.add.at(below, a, (v < lo[a]).astype(float))
    cell = np.clip(np.floor((v - lo[a]) / np.where(w > 0, w, 1)[a] * bins), 0, bins - 1).astype(np.int64)
    inside = (v >= lo[a]) & (v <= (lo + w)[a])
    flat = ((a[:, None] * p + np.arange(p)) * bins + cell)[inside]
    return below, np.bincount(flat, minlength=k * p * bins).reshape(k, p, bins)


def _assign_stats(df, vec, runs: list[_Run], span: tuple[np.ndarray, np.ndarray] | None, bins: int) -> None:
    """Per run: cluster counts, sums and costs; median runs also get a first histogram
    of every feature over its overall range, in the same pass."""
    models, wide = _views(runs), [_uses_median(r) and span is not None for r in runs]

    def part(x):
        out = []
        for m, histogram in zip(models, wide):
            d = m.distances(x)
            a = d.argmin(axis=1)
            k, v = len(m.centers), m.entries(x)
            hot = np.zeros((len(x), k))
            hot[np.arange(len(x)), a] = 1.0
            best = d[np.arange(len(x)), a]
            out += [hot.sum(0), hot.T @ v, hot.T @ cost(best, m.metric), hot.T @ best]
            if histogram:
                lo = np.repeat(m.entries(span[0][None]), k, axis=0)
                hi = np.repeat(m.entries(span[1][None]), k, axis=0)
                out.append(_histogram(v, a, k, lo, hi - lo, bins)[1])
            else:
                out.append(np.zeros((k, 0)))
        return out

    numbers = sum(r.centers.size * (1 + bins * h) + 3 * len(r.centers) for r, h in zip(runs, wide))
    flat = sum_rows(df, [vec], part, numbers=numbers)
    for i, r in enumerate(runs):
        r.stats = dict(zip(("n", "sum", "cost", "dist", "hist"), flat[5 * i:5 * i + 5]))


MEDIAN_PASSES = 12  # at 32 bins the last bracket is 2^-60 of the feature's range


KEEP = 16  # smallest values of a bracket that a pass returns


def _narrow(lo, w, below, hist, rank):
    """The histogram cell that holds the wanted rank, a hair wider than computed so that a
    value on its edge cannot fall out, and about how many of its values are smaller."""
    bins = hist.shape[-1]
    seen = below[..., None] + hist.cumsum(axis=-1)
    at = np.clip((seen <= rank[:, None, None]).sum(axis=-1), 0, bins - 1)
    cell = np.take_along_axis(hist, at[..., None], axis=-1)[..., 0]
    before = np.take_along_axis(seen, at[..., None], axis=-1)[..., 0] - cell
    return lo + (at - 1e-9) * w / bins, w / bins * (1 + 2e-9), rank[:, None] - before


def _smallest(v, a, k, lo, w):
    """Per (cluster, feature): rows below the bracket, its ``KEEP`` smallest values and its largest."""
    below, low, high = np.zeros((k, v.shape[1])), np.full((k, v.shape[1], KEEP), np.inf), np.full((k, v.shape[1]), -np.inf)
    for c in np.unique(a):
        x = v[a == c]
        under, inside = x < lo[c], (x >= lo[c]) & (x <= lo[c] + w[c])
        below[c] = under.sum(axis=0)
        high[c] = np.where(inside, x, -np.inf).max(axis=0)
        first = np.sort(np.where(inside, x, np.inf), axis=0)[:KEEP]
        low[c, :, :len(first)] = first.T
    return below, low, high


def _merge_smallest(a, b):
    smallest = lambda x, y: np.sort(np.concatenate([x, y], axis=-1), axis=-1)[..., :KEEP]
    return [(np.add, smallest, np.maximum)[i % 3](x, y) for i, (x, y) in enumerate(zip(a, b))]


def _medians(df, vec, runs: list[_Run], span: tuple[np.ndarray, np.ndarray], bins: int = NARROW) -> dict[int, np.ndarray]:
    """Median of every (run, cluster, feature): the histogram of the assignment pass is narrowed around
    the two middle ranks until few values are left below them in their brackets; a pass then returns
    these values, one of which is the exact answer.  A pass has a fixed-size summary, however many rows
    a cluster holds.  ``bins`` is the histogram width of the narrowing passes."""
    models, cells = _views(runs), sum(r.centers.size for r in runs)
    lo, w, depth, ranks = [], [], [], []
    for r in runs:
        k, p = r.centers.shape
        lo0 = np.repeat(r.entries(span[0])[None], k, axis=0)
        w0 = np.repeat(r.entries(span[1] - span[0])[None], k, axis=0)
        ranks.append([np.floor((r.stats["n"] - 1) / 2), np.ceil((r.stats["n"] - 1) / 2)])
        both = [_narrow(lo0, w0, np.zeros((k, p)), r.stats["hist"], rank) for rank in ranks[-1]]
        for out, i in ((lo, 0), (w, 1), (depth, 2)):
            out.append([b[i] for b in both])
    value = {id(r): np.zeros((2, *r.centers.shape)) for r in runs}
    collect = False
    for _ in range(MEDIAN_PASSES):
        collect = not collect and all((d[r.stats["n"] > 0] < KEEP - 2).all() for r, both in zip(runs, depth) for d in both)
        summary = _smallest if collect else (lambda v, a, k, lo_t, w_t: _histogram(v, a, k, lo_t, w_t, bins))

        def part(x, lo=lo, w=w, summary=summary):
            out = []
            for m, lo_r, w_r in zip(models, lo, w):
                a, v = m.distances(x).argmin(axis=1), m.entries(x)
                for t in range(2):
                    out += summary(v, a, len(m.centers), lo_r[t], w_r[t])
            return out

        flat = sum_rows(df, [vec], part, _merge_smallest, numbers=2 * cells * (KEEP + 2)) if collect else \
            sum_rows(df, [vec], part, numbers=2 * cells * (bins + 1))
        exact, size = collect, 3 if collect else 2
        for i, r in enumerate(runs):
            for t in range(2):
                found = flat[2 * size * i + size * t:2 * size * i + size * (t + 1)]
                if not collect:
                    lo[i][t], w[i][t], depth[i][t] = _narrow(lo[i][t], w[i][t], *found, ranks[i][t])
                    continue
                below, low, high = found
                at = ranks[i][t][:, None] - below
                picked = np.take_along_axis(low, np.clip(at, 0, KEEP - 1).astype(int)[..., None], axis=-1)[..., 0]
                single = low[..., 0] == high
                known = single | ((at >= 0) & (at < KEEP) & np.isfinite(picked))
                value[id(r)][t] = np.where(single, high, np.where(known, picked, lo[i][t] + w[i][t] / 2))
                exact = exact and bool((known | (r.stats["n"] == 0)[:, None]).all())
        if exact:
            break
    return {key: v.mean(axis=0) for key, v in value.items()}


def _span(df, vec) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every feature."""
    lo, hi = sum_rows(df, [vec], lambda x: (x.min(axis=0), x.max(axis=0)),
                      lambda a, b: (np.minimum(a[0], b[0]), np.maximum(a[1], b[1])), numbers=1000)
    return lo, hi


def _refill(df, code, vec, runs: list[_Run], p: int) -> None:
    """Rows for empty clusters: standard runs draw a random row of the largest cluster,
    enhanced runs take the row furthest from the center of the most dispersed cluster."""
    models = _views(runs)
    source, empties = [], []
    for r in runs:
        n = r.stats["n"]
        spread = np.where(n > 1, r.stats["dist"] / np.maximum(n, 1), -1)
        source.append(int(spread.argmax()) if r.spec.enhanced else int(n.argmax()))
        empties.append(np.flatnonzero(n == 0))
    most = max(len(e) for e in empties)
    taken: list[list[np.ndarray]] = [[] for _ in runs]
    for turn in range(most):
        def part(c, x, turn=turn):
            scores, picks = np.full(len(models), np.inf), np.zeros((len(models), p))
            for i, (m, r) in enumerate(zip(models, runs)):
                d = m.distances(x)
                mine = d.argmin(axis=1) == source[i]
                for t in taken[i]:
                    mine &= ~(x == t).all(axis=1)
                if mine.any():
                    s = -d[:, source[i]] if r.spec.enhanced else -np.log(uniform(c, r.seed * 7919 + r.rounds * 31 + turn))
                    s = np.where(mine, s, np.inf)
                    j = int(s.argmin())
                    scores[i], picks[i] = s[j], x[j]
            return scores, picks

        scores, picks = sum_rows(df, [code, vec], part, keep_smallest, numbers=len(runs) * (p + 1))
        for i, r in enumerate(runs):
            if turn < len(empties[i]) and np.isfinite(scores[i]):
                r.centers[empties[i][turn]] = r.entries(picks[i])
                if not r.spec.enhanced:
                    taken[i].append(picks[i])


def fit_many(df: DataFrame, key: str, vec: str, specs: dict[str, Spec], max_iter: int = 300, tol: float | None = None
             ) -> dict[str, KMeansModel]:
    """Fit every spec; per spec the restart with the lowest cost wins."""
    data = KeptRows(df.select(F.xxhash64(F.col(key)).alias("code"), F.col(vec).alias("v")), ["code", "v"])
    try:
        p = data.width("v")
        runs = []
        for name, s in specs.items():
            d = s.dims or p - s.start
            w = None if s.weights is None else np.asarray(s.weights, float)
            if w is not None and len(w) != d:
                raise ValueError(f"{len(w)} feature weights for {d} features")
            if s.init is not None:
                runs.append(_Run(name, s, s.seed, np.array(s.init, float), w))
            else:
                runs += [_Run(name, s, s.seed + 101 * i, np.zeros((0, d)), w) for i in range(s.n_init)]
        _seed_centers(data, "code", "v", runs, p)
        span = _span(data, "v") if any(_uses_median(r) for r in runs) else None
        for _ in range(max_iter):
            active = [r for r in runs if not r.done]
            if not active:
                break
            bins = _bins(active)
            _assign_stats(data, "v", active, span, bins)
            holes = [r for r in active if (r.stats["n"] == 0).any()]
            wide = [r for r in active if _uses_median(r)]
            medians = _medians(data, "v", wide, span) if wide else {}
            old = {id(r): r.centers.copy() for r in active}
            for r in active:
                n = r.stats["n"]
                full = n > 0
                target = np.where(full[:, None], r.stats["sum"] / np.maximum(n, 1)[:, None], r.centers)
                if id(r) in medians:
                    target = np.where((n > 5)[:, None], medians[id(r)], target)
                if r.spec.enhanced:
                    step = target - r.centers
                    if r.velocity is not None:
                        step = step / (1 + 0.1 * r.rounds) + r.spec.momentum * r.velocity
                    r.velocity = np.where(full[:, None], step, 0.0)
                    r.centers = r.centers + r.velocity
                else:
                    r.centers = target
                r.rounds += 1
            if holes:
                _refill(data, "code", "v", holes, p)
            for r in active:
                moved = r.centers - old[id(r)]
                total = r.stats["cost"].sum()
                if r.spec.enhanced:
                    r.stale = 0 if total < r.prev_cost else r.stale + 1
                    r.done = r.stale >= 5 or np.abs(moved).max() < (1e-6 if tol is None else tol)
                else:
                    r.done = np.linalg.norm(moved) < (1e-4 if tol is None else tol)
                r.prev_cost = total
        _assign_stats(data, "v", runs, None, 1)
        late = sum(not r.done for r in runs)
        if late:
            warnings.warn(f"{late} of {len(runs)} k-means runs did not converge in {max_iter} rounds", stacklevel=2)
        best: dict[str, KMeansModel] = {}
        for r in runs:
            r.inertia = float(r.stats["cost"].sum())
            if r.name not in best or r.inertia < best[r.name].inertia:
                best[r.name] = r.model()
        return best
    finally:
        data.unpersist()


def kmeans(df: DataFrame, key: str, vec: str, k: int, n_init: int = 10, max_iter: int = 300, tol: float = 1e-4,
           seed: int = 42, init: np.ndarray | None = None) -> KMeansModel:
    return fit_many(df, key, vec, {"m": Spec(k, n_init, seed=seed, init=init)}, max_iter, tol)["m"]


def enhanced_kmeans(df: DataFrame, key: str, vec: str, k: int, metric: str = "euclidean", n_init: int = 15,
                    max_iter: int = 300, tol: float = 1e-6, seed: int = 42, weights: Sequence[float] | None = None,
                    outlier_handling: bool = True, momentum: float = 0.1) -> KMeansModel:
    spec = Spec(k, n_init, seed=seed, metric=metric, weights=weights, enhanced=True, momentum=momentum,
                outlier_handling=outlier_handling)
    return fit_many(df, key, vec, {"m": spec}, max_iter, tol)["m"]


# ---- single steps as declarative plans ---------------------------------------------------

def nearest(vec: str, centers: np.ndarray) -> Column:
    """Index of the nearest center (lowest index on ties) as a built-in expression."""
    d = F.array(*[F.named_struct(F.lit("d"), sq_dist(F.col(vec), literal_vector(c)), F.lit("j"), F.lit(j))
                  for j, c in enumerate(centers)])
    return F.array_min(d)["j"]


def lloyd_step(df: DataFrame, vec: str, centers: np.ndarray) -> np.ndarray:
    """Assign and average once; an empty cluster keeps its center."""
    out = np.array(centers, float)
    for r in class_moments(df.select(nearest(vec, centers).alias("j"), vec), vec, ["j"]).select("j", "mean").collect():
        out[r["j"]] = r["mean"]
    return out


def median_step(df: DataFrame, vec: str, centers: np.ndarray) -> np.ndarray:
    """Assign once and move each center to the exact per-feature median of its rows (mean
    for five rows or fewer)."""
    k, p = centers.shape
    a = df.select(nearest(vec, centers).alias("j"), F.col(vec).alias("v")).persist()
    try:
        sizes = {r["j"]: r["n"] for r in a.groupBy("j").agg(F.count("*").alias("n")).collect()}
        q = exact_quantiles(a, {f"{j}_{i}": F.when(F.col("j") == j, F.col("v")[i])
                                for j in range(k) for i in range(p)}, [0.5], rows=sum(sizes.values()))
        out = np.array(centers, float)
        for j, n in sizes.items():
            if n > 5:
                out[j] = [q[f"{j}_{i}"][0] for i in range(p)]
            else:
                row = a.where(F.col("j") == j).agg(*[F.avg(F.col("v")[i]) for i in range(p)]).first()
                out[j] = list(row)
        return out
    finally:
        a.unpersist()


def centers_frame(df: DataFrame, centers: np.ndarray) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [(j, i, float(v)) for j, c in enumerate(centers) for i, v in enumerate(c)], "cluster int, i int, center double")


def inertia_by_cluster(df: DataFrame, vec: str, centers: np.ndarray) -> DataFrame:
    d = F.array_min(F.array(*[F.named_struct(F.lit("d"), sq_dist(F.col(vec), literal_vector(c)), F.lit("j"), F.lit(j))
                              for j, c in enumerate(centers)]))
    return df.select(d.alias("b")).groupBy(F.col("b.j").alias("cluster")).agg(
        F.count("*").alias("rows"), F.sum("b.d").alias("inertia"))


def cluster_importance(df: DataFrame, vec: str, cluster: str) -> DataFrame:
    """Feature weights: sum over clusters of 1 / (population variance + 1e-10), normalised.
    Clusters of one row do not count."""
    per = moments_long(df, vec, [cluster]).where("n > 1")
    raw = per.groupBy("i").agg(F.sum(1 / (F.col("var") + 1e-10)).alias("w"))
    return raw.select("i", (F.col("w") / raw.agg(F.sum("w")).scalar()).alias("importance"))
