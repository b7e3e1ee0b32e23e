"""Exact quantiles (linear interpolation) with bounded memory per task.

Spark's exact ``percentile`` keeps every distinct value of a group in one buffer.  Here
the approximate quantile first brackets the wanted ranks; the bracket is narrowed until it
holds few rows or one value, and only then the exact aggregate runs inside the bracket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT_ROWS = 1_000_000  # exact aggregate over at most this many values
ACCURACY = 10_000
CHUNK = 200  # aggregates per job, to stay inside codegen limits


def exact_quantiles(
    df: DataFrame, cols: dict[str, Column], probs: Sequence[float], rows: int | None = None,
    exact_rows: int | None = None,
) -> dict[str, list[float]]:
    """``{name: [quantile for each prob]}`` for each expression; nulls are ignored."""
    limit = EXACT_ROWS if exact_rows is None else exact_rows
    names = list(cols)
    n = df.count() if rows is None else rows
    if n <= limit:
        out: dict[str, list[float]] = {}
        for at in range(0, len(names), CHUNK):
            part = names[at:at + CHUNK]
            row = df.agg(*[
                F.percentile(cols[c], F.array(*[F.lit(float(p)) for p in probs])).alias(f"q{i}")
                for i, c in enumerate(part)]).first()
            out.update({c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else [None] * len(probs))
                        for i, c in enumerate(part)})
        return out
    out = {}
    for at in range(0, len(names), max(1, CHUNK // (4 * len(probs)))):
        part = names[at:at + max(1, CHUNK // (4 * len(probs)))]
        out.update(_bracketed(df, {c: cols[c] for c in part}, probs, limit))
    return out


def _bracketed(df, cols, probs, limit):
    counts = df.agg(*[F.count(e).alias(f"n{i}") for i, e in enumerate(cols.values())]).first()
    names = list(cols)
    ranks = {}  # (column, prob) -> zero-based fractional rank
    for i, c in enumerate(names):
        for j, p in enumerate(probs):
            ranks[(c, j)] = (counts[f"n{i}"] - 1) * p if counts[f"n{i}"] else None
    state = {k: {"lo": None, "hi": None, "below": 0, "inside": counts[f"n{names.index(k[0])}"]}
             for k, r in ranks.items() if r is not None}
    answer: dict[tuple[str, int], float | None] = {k: None for k, r in ranks.items() if r is None}
    while state:
        open_ = {k: s for k, s in state.items() if s["inside"] > limit}
        if not open_:
            break
        exprs = []
        for i, (k, s) in enumerate(open_.items()):
            f = (ranks[k] - s["below"]) / max(s["inside"] - 1, 1)
            step = 2.0 / ACCURACY
            exprs.append(F.percentile_approx(
                _inside(cols[k[0]], s), [max(0.0, f - step), min(1.0, f + step)], ACCURACY).alias(f"b{i}"))
        row = df.agg(*exprs).first()
        for i, (k, s) in enumerate(open_.items()):
            s["lo"], s["hi"] = (float(v) for v in row[f"b{i}"])
        tally = df.agg(*[
            agg for i, (k, s) in enumerate(open_.items()) for agg in (
                F.count_if(cols[k[0]] < s["lo"]).alias(f"u{i}"),
                F.count(_inside(cols[k[0]], s)).alias(f"v{i}"),
                F.count_if(cols[k[0]] == s["lo"]).alias(f"l{i}"),
                F.count_if(cols[k[0]] == s["hi"]).alias(f"h{i}"))]).first()
        for i, (k, s) in enumerate(open_.items()):
            before = s["inside"]
            s["below"], s["inside"] = tally[f"u{i}"], tally[f"v{i}"]
            lo_rank, hi_rank = int(ranks[k]), int(-(-ranks[k] // 1))
            if s["below"] > lo_rank or hi_rank >= s["below"] + s["inside"]:
                raise RuntimeError("quantile bracket lost its rank")
            if hi_rank < s["below"] + tally[f"l{i}"]:
                answer[k] = s["lo"]
            elif lo_rank >= s["below"] + s["inside"] - tally[f"h{i}"]:
                answer[k] = s["hi"]
            elif s["inside"] >= before:
                s["inside"] = 0  # few distinct values fill the bracket: the aggregate is small
        state = {k: s for k, s in state.items() if k not in answer}
    if state:
        tally = df.agg(*[F.count(_inside(cols[k[0]], s)).alias(f"v{i}")
                         for i, (k, s) in enumerate(state.items())]).first()
        row = df.agg(*[
            F.percentile(_inside(cols[k[0]], s),
                         F.lit((ranks[k] - s["below"]) / max(tally[f"v{i}"] - 1, 1))).alias(f"q{i}")
            for i, (k, s) in enumerate(state.items())]).first()
        for i, k in enumerate(state):
            answer[k] = row[f"q{i}"]
    return {c: [answer[(c, j)] for j in range(len(probs))] for c in names}


def _inside(e: Column, s: dict) -> Column:
    if s["lo"] is None:
        return e
    return F.when((e >= s["lo"]) & (e <= s["hi"]), e)
