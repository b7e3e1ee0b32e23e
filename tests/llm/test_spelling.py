import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from cases import clashing, documents, same, texts
from wideloom.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_words(rows, every=31, letters=7, least=2):
    seen = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= least}


def edits(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    yield from (a + b[1:] for a, b in cuts if b)
    yield from (a + c + b[1:] for a, b in cuts if b for c in letters)
    yield from (a + c + b for a, b in cuts for c in letters)


def plain_groups(words, ratio=10):
    letters = {c for w in words for c in w}
    out = []
    forms = {}
    for w, n in words.items():
        near = {e for e in edits(w, letters) if e in words and e != w}
        best = min(near, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * n:
            forms[w] = best
        out.append([w, n, len(near), forms.get(w), words.get(forms.get(w))])
    for r in out:
        root = r[0]
        while root in forms:
            root = forms[root]
        r.append(root)
    return [tuple(r) for r in out]


def variants(seed, n):
    """Words over few letters, many of them an edit apart, with long chains of forms."""
    rng = random.Random(seed)
    letters = "abcé÷"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(n // 4)}
    while len(words) < n:
        words.add(rng.choice(list(edits(rng.choice(sorted(words)), letters))))
    return {w: rng.choice([2, 3, 40, 500, 6000, 80_000]) for w in words if len(w) >= 4}


@pytest.mark.parametrize("seed", range(4))
def test_every_pair_and_root(spark, seed):
    words = variants(seed, 500)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert same(spelling.variant_groups(df).select("word", "n", "n_near", "form", "form_n", "root").collect(), plain_groups(words))


def test_chain_of_forms(spark):
    words = {"a" * i + "bcdefgh": 2 * 10 ** i for i in range(9)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: r.root for r in spelling.variant_groups(df).collect()}
    assert set(got.values()) == {"aaaaaaaabcdefgh"}


def test_words_of_awkward_texts(spark):
    rows = list(enumerate(texts(3, 60))) + [(None, "Señoritas señoritas SEÑORITAS naïveté÷× Überfall überfall")] * 2
    rows += [(900 + i, "misspelling mispelling Misspelling") for i in range(40)]
    want = plain_words(rows, every=3)
    got = {r.word: r.n for r in spelling.counted_words(documents(spark, rows), every=3).collect()}
    assert got == want and any("misspellin" in w for w in want)
    full = spelling.spelling_variants(documents(spark, rows), every=3).select("word", "n", "n_near", "form", "form_n", "root")
    assert same(full.collect(), plain_groups(want))


def test_a_frequent_word_and_early_flushes(spark, monkeypatch):
    monkeypatch.setattr(spelling, "FLUSH", 5)
    rows = [(i, "boilerplate " * 50 + f"boilerplat{'abc'[i % 3]}") for i in range(300)]
    got = {r.word: r.n for r in spelling.counted_words(documents(spark, rows)).collect()}
    assert got == plain_words(rows)


def test_pivots_are_disjoint_and_lightest():
    rng = random.Random(1)
    for _ in range(300):
        at = sorted(rng.sample(range(12), rng.randint(3, 8)))
        grams = [(i, rng.randint(1, 9)) for i in at]
        a, b = spelling.disjoint_pair(grams)
        weight = dict(grams)
        assert b - a >= 2
        assert weight[a] + weight[b] == min(x + y for (i, x), (j, y) in combinations(grams, 2) if j - i >= 2)


def test_empty_extra_and_refused(spark):
    assert spelling.spelling_variants(documents(spark, [])).collect() == []
    assert spelling.spelling_variants(documents(spark, [None, "", "short words"])).collect() == []
    df = documents(spark, texts(4, 80) * 2)
    once = spelling.spelling_variants(df, least_letters=4).collect()
    assert once and same(once, spelling.spelling_variants(clashing(df).repartition(6), least_letters=4).collect())
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, least_letters=3)
    with pytest.raises(ValueError):
        spelling.spelling_variants(df, ratio=1)
