import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cases import clashing, documents, prose, same, texts
from wideloom.llm import repeats
from wideloom.llm.queries import QUERIES


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (k, _), d in zip(rows, data):
        on = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                on[i:i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], on.astype(int), [0]])))
        kept = bytes(b for b, o in zip(d, on) if not o)
        out.append((k, len(d), int(on.sum()), [int(x) for x in edges[::2]], [int(x) for x in edges[1::2]],
                    hashlib.sha256(kept).hexdigest()))
    return out


def spliced(seed, n=50):
    """Texts that share passages of all lengths, with periodic and repeated ones."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(0, 400))) for _ in range(25)]
    out = []
    for _ in range(n):
        t = rng.choice(base)
        for _ in range(3):
            s, p = rng.choice(base), rng.randint(0, len(t))
            a = rng.randint(0, len(s))
            t = t[:p] + s[a:a + rng.randint(0, 120)] + t[p:]
        out.append(t)
    return out + ["", None, "a" * 150, "ab" * 90, "xyz" * 9] + out[:6] + out[:1] * 5


@pytest.mark.parametrize("length", [7, 20, 60])
def test_against_counting_all_strings(spark, length):
    rows = list(enumerate(spliced(length)))
    assert same(repeats.without_repeats(documents(spark, rows), length=length).drop("shares_passage").collect(), brute(rows, length))


def test_large_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SPANS_PER_TASK", 3)
    monkeypatch.setattr(repeats, "BATCH_BYTES", 500)
    rows = list(enumerate(spliced(9, 80)))
    assert same(repeats.without_repeats(documents(spark, rows).repartition(5), length=25).drop("shares_passage").collect(), brute(rows, 25))


def test_query(spark, tmp_path):
    rng = random.Random(4)
    core = prose(rng, 150)
    rows = list(enumerate([prose(rng, 50) + core[i:] + prose(rng, 20) for i in range(0, 60, 7)] + texts(4, 6) + [core[:399], core[:400]]))
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op7_repeated_strings"](spark, str(tmp_path)).collect()
    assert got[0].__fields__[-1] == "shares_passage"
    assert same([r[:-1] for r in got], [(k, n, m, len(a), h) for k, n, m, a, _, h in brute(rows, 400)])


def test_empty_null_and_extra(spark):
    assert repeats.without_repeats(documents(spark, [])).collect() == []
    rows = [(None, "q" * 50), (1, "q" * 50), (1, "q" * 50), (2, None)]
    df = documents(spark, rows)
    assert same(repeats.without_repeats(clashing(df), length=30).drop("shares_passage").collect(), brute(rows, 30))
    assert same(repeats.without_repeats(df, length=30).drop("shares_passage").collect(), brute(rows, 30))


@pytest.mark.parametrize("limit", [7, 20, 100, 320])
def test_difference_cover(limit):
    cover, v = repeats.difference_cover(limit)
    assert v <= limit and {(a - b) % v for a in cover for b in cover} == set(range(v))
    assert len(cover) * (len(cover) - 1) == v - 1


def test_sliding_least():
    x = np.random.default_rng(1).integers(0, 2**63, 200).astype(np.uint64)
    for w in (1, 2, 7, 199, 200):
        assert np.array_equal(repeats.sliding_least(x, w), [x[i:i + w].min() for i in range(len(x) - w + 1)])


def test_shared_passages(spark):
    rng = random.Random(11)
    core = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(200)]
    own = lambda n: [f"v{rng.randint(0, 10 ** 9)}" for _ in range(n)]
    found, left = [], []
    for at in [*range(0, 140, 9)] * 2:
        found.append("  \n".join(own(rng.randint(0, 60)) + core[at:at + 51] + own(rng.randint(0, 60))))
    for _ in range(12):
        a = own(40)
        left += [" ".join(own(30) + a + own(30)) for _ in range(2)]
    found += [" ".join(own(70))] * 2  # copies
    left += ["", None, " ".join(core[:30]), " ".join(own(50)), " ".join(["same"] * 300)]
    rows = list(enumerate(found + left))
    got = {r.doc_id for r in repeats.without_repeats(clashing(documents(spark, rows)).repartition(4)).where("shares_passage").collect()}
    assert got == set(range(len(found)))


def test_a_third_of_the_texts_hold_one_passage(spark):
    """Names of one frequent string and marked texts are spread over the tasks, and all are found."""
    rng = random.Random(12)
    core = prose(rng, 120)
    rows = list(enumerate([prose(rng, 40) + core + prose(rng, 40) for _ in range(150)] + [prose(rng, 90) for _ in range(300)]))
    got = repeats.without_repeats(documents(spark, rows).repartition(16)).collect()
    assert all((r.n_removed >= len(core.encode()) and r.shares_passage) == (r.doc_id < 150) for r in got)
