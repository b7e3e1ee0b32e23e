import random

from cases import clashing, documents, prose, same, texts
from wideloom.llm.ngram_join import Banding, near_duplicates, ngrams, one_per_group


def brute(rows):
    sets = [frozenset(ngrams(t or "").tolist()) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - both
            if union == 0 or 5 * both >= 4 * union:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, least.get(find(i)), links[i]) for i, (k, _) in enumerate(rows)]


def near_family(seed, n, words=150):
    """Variants of one text, each with a few words changed: a chain of near copies."""
    rng = random.Random(seed)
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = f"changed{rng.randint(0, 9)}"
        out.append(" ".join(w))
    return out


def check(spark, rows):
    got = near_duplicates(documents(spark, rows)).select("doc_id", "class_id", "n_links").collect()
    assert same(got, brute(rows))


def test_against_all_pairs(spark):
    check(spark, list(enumerate(texts(1) + near_family(2, 25) + near_family(3, 12, 40))))


def test_null_and_repeated_keys(spark):
    some = texts(4, 10)
    check(spark, [(7, some[0]), (7, some[0]), (None, some[0]), (None, some[1]), (None, None), (9, ""), (8, some[1] + " x")])


def test_large_group_is_cut_into_blocks(spark, monkeypatch):
    import wideloom.llm.ngram_join as join

    monkeypatch.setattr(join, "BLOCK_ROWS", 16)
    check(spark, list(enumerate(near_family(5, 90) + texts(6, 5))))


def test_empty_table(spark):
    df = documents(spark, [])
    assert near_duplicates(df).collect() == []
    assert one_per_group(df).columns == df.columns


def test_extra_columns(spark):
    rows = texts(7, 12)
    df = documents(spark, rows)
    assert same(near_duplicates(clashing(df)).collect(), near_duplicates(df).collect())
    kept = one_per_group(clashing(df))
    assert kept.columns == clashing(df).columns and kept.count() == one_per_group(df).count()


def test_one_row_of_each_group_stays(spark):
    rows = list(enumerate(texts(8) + near_family(9, 10))) + [(3, texts(8)[3])]
    kept = [r.doc_id for r in one_per_group(documents(spark, rows)).collect()]
    assert sorted(kept) == sorted({c for _, c, _ in brute(rows)})


def test_banding_reaches_the_target():
    b = Banding.choose(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** b.rows) ** b.bands >= 0.9999 > 1 - (1 - 0.8 ** b.rows) ** (b.bands - 1)
