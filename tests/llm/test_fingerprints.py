import hashlib
import random

import numpy as np

from cases import clashing, documents, prose, same, texts
from wideloom.llm import fingerprints as fp


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    out = []
    for i, (k, t) in enumerate(rows):
        t, u = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        a, b, c = (fp.sketches([x])[0] for x in (t, e, u))
        out.append((k, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.written(a), fp.written(b),
                    fp.likeness(a, b), fp.likeness(a, c)))
    return out


def test_against_plain_order(spark):
    rows = list(enumerate(texts(1)))
    random.Random(1).shuffle(rows)
    for parts in (1, 6):
        assert same(fp.edited_fingerprints(documents(spark, rows).repartition(parts)).collect(), brute(rows))


def test_null_repeated_and_single_keys(spark):
    rows = [(None, "first"), (3, "three" * 20), (3, "three" * 20), (3, "other"), (2**60, "big"), (-5, None), (None, "")]
    assert same(fp.edited_fingerprints(documents(spark, rows)).collect(), brute(rows))
    assert same(fp.edited_fingerprints(documents(spark, [(4, "alone here")])).collect(), brute([(4, "alone here")]))
    assert fp.edited_fingerprints(documents(spark, [])).collect() == []
    df = documents(spark, rows)
    assert same(fp.edited_fingerprints(clashing(df)).collect(), fp.edited_fingerprints(df).collect())


def test_batch_does_not_matter(spark):
    some = [t or "" for t in texts(2)]
    together = fp.sketches(some)
    assert all(np.array_equal(a, fp.sketches([t])[0]) for a, t in zip(together, some))
    got = {r.doc_id: r.f for r in documents(spark, texts(2)).select("doc_id", fp.fingerprint().alias("f")).collect()}
    assert [got[i] for i in range(len(some))] == [fp.written(s) for s in together]
    assert all(np.array_equal(fp.read(fp.written(s)), s) for s in together)


def test_equal_substrings_share_interior_names():
    rng = random.Random(3)
    core = prose(rng, 300)
    owned = lambda text: set(fp.phrase_names([text])[0].tolist())
    a = owned(core)
    for cut in (1, 2, 3, 17, 101):
        shared = a & owned(prose(rng, 40)[:cut] + core + prose(rng, 20))
        assert len(shared) > 0.7 * len(a)
    assert len(a & owned(prose(random.Random(99), 300))) < 0.05 * len(a)


def test_likeness_follows_the_shared_part():
    rng = random.Random(4)
    whole = prose(rng, 600)
    sketch = lambda t: fp.sketches([t])[0]
    near = [fp.likeness(sketch(whole), sketch(whole[:int(len(whole) * s)] + prose(rng, 600)[:int(len(whole) * (1 - s))]))
            for s in (0.95, 0.5, 0.1)]
    assert near[0] > 0.7 > near[1] > 0.15 > near[2]
    assert fp.likeness(sketch(whole), sketch(whole)) == 1.0 and fp.likeness(sketch(""), sketch("")) == 1.0
    assert fp.likeness(sketch(""), sketch(whole)) == 0.0


def test_phrases_stay_short():
    for text in ("a" * 5000, "ab" * 3000, prose(random.Random(5), 2000), "".join(map(chr, range(32, 5000)))):
        sym = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
        sym, doc = fp._collapsed(sym, np.zeros(len(sym), int))
        at = np.flatnonzero(fp._phrase_starts(sym, doc))
        assert np.diff(np.append(at, len(sym))).max() <= 24
