import random

import pytest

from cases import clashing, documents, prose, same, texts
from wideloom.llm import decontaminate as dc


def distance(item, text):
    """Least edit distance of item to a run of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item):
        new = [i + 1]
        for j, x in enumerate(text):
            new.append(min(row[j] + (w != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def items(seed, n=12):
    rng = random.Random(seed)
    return [prose(rng, rng.randint(14, 60)) for _ in range(n)]


def edited(rng, words, k, vocabulary):
    w = list(words)
    for _ in range(k):
        p, o = rng.randrange(len(w)), rng.random()
        if o < 0.4:
            w[p] = rng.choice(vocabulary)
        elif o < 0.7 and len(w) > 1:
            del w[p]
        else:
            w.insert(p, rng.choice(vocabulary))
    return w


@pytest.mark.parametrize("seed", range(5))
def test_edit_search_against_the_table(seed):
    rng = random.Random(seed)
    for _ in range(60):
        item, text = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, n))] for n in (80, 120)]
        got, end = dc.edit_search(item, text)
        assert got == distance(item, text)
        found = dc.locate(item, text, len(item))
        if found:
            a, b, edits = found
            assert edits == got and b == end
            plain = [list(range(len(text[a:b]) + 1))]
            for i, w in enumerate(item):
                new = [i + 1]
                for j, x in enumerate(text[a:b]):
                    new.append(min(plain[-1][j] + (w != x), plain[-1][j + 1] + 1, new[j] + 1))
                plain.append(new)
            assert plain[-1][-1] == edits


def test_exact_passages_are_always_found(spark):
    rng = random.Random(1001)
    marks = items(1)
    rows, want = [], set()
    for i in range(60):
        t = prose(rng, rng.randint(0, 200))
        for m in rng.sample(range(len(marks)), rng.randint(0, 3)):
            t = f"{t} {marks[m].upper()}! {prose(rng, rng.randint(0, 30))}"
            want.add((i, m))
        rows.append((i, t))
    bench = spark.createDataFrame(list(enumerate(marks)), "item_id long, text string")
    got = dc.contaminated(documents(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want and all(r.edits == 0 for r in got)
    for r in got:
        assert dc.words(rows[r.doc_id][1])[r.start_word:r.end_word] == dc.words(marks[r.item_id])


def test_recall_and_precision_against_all_pairs():
    rng = random.Random(2)
    marks = items(2, 20)
    index = dc.Index(marks)
    vocabulary = [w for t in items(3) for w in dc.words(t)]
    hit = total = 0
    for share in (0.1, 0.2):
        for m, item in enumerate(index.items):
            for _ in range(10):
                w = edited(rng, item, int(share * len(item)), vocabulary)
                text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))] + w + [rng.choice(vocabulary) for _ in range(40)]
                found = {i: e for i, _, _, e in index.find([b" ".join(text).decode()])[0]}
                for i, x in enumerate(index.items):
                    true = distance(x, text)
                    if i == m and true <= index.search.edits(len(x)):
                        total += 1
                        hit += i in found
                    if i in found:
                        assert found[i] == true <= index.search.edits(len(x))
    assert hit / total >= 0.9


@pytest.mark.parametrize("low, high, least", [(5, 8, 1.0), (9, 14, 1.0), (15, 18, 1.0), (19, 23, 1.0), (24, 31, 0.9), (32, 47, 0.9),
                                              (48, 90, 0.9), (91, 160, 0.9)])
def test_recall_of_each_length_at_the_limit(low, high, least):
    rng = random.Random(low)
    vocabulary = [b"w%d" % i for i in range(3000)]
    marks = [[rng.choice(vocabulary) for _ in range(rng.randint(low, high))] for _ in range(60)]
    index = dc.Index([b" ".join(m).decode() for m in marks])
    hit = total = 0
    for i, item in enumerate(index.items):
        for _ in range(4):
            w = edited(rng, item, index.search.edits(len(item)), vocabulary)
            text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 50))] + w + [rng.choice(vocabulary) for _ in range(40)]
            true = distance(item, text)
            found = {j: e for j, _, _, e in index.find([b" ".join(text).decode()])[0]}
            total += 1
            hit += i in found
            assert true <= index.search.edits(len(item)) and found.get(i, true) == true
    assert hit / total >= least


def test_short_items_are_found_exactly():
    index = dc.Index(["one two three", "solo", "a b c d e f", "", None, "..."])
    found = lambda t: [h[0] for h in index.find([t])[0]]
    assert found("zero one two three four") == [0] and found("x solo") == [1] and found("one two four three") == []
    assert found("q a b X d e f") == [2] and found("") == [] and found("...") == []


def test_items_in_blocks_and_empty_tables(spark):
    marks = items(4, 7)
    bench = spark.createDataFrame(list(enumerate(marks)) + [(3, None), (None, marks[0])], "item_id long, text string")
    rows = [(i, f"x {m} y") for i, m in enumerate(marks)] + [(100 + i, t) for i, t in enumerate(texts(44, 5))] + [(None, marks[1])]
    df = documents(spark, rows)
    whole = dc.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in whole} == {(i, i) for i in range(7)} | {(0, None), (None, 1)}
    assert same(dc.contaminated(clashing(df), bench, search=dc.Search(block=2)).collect(), whole)
    kept = dc.decontaminated(clashing(df), bench, search=dc.Search(block=3))
    assert kept.columns == clashing(df).columns and kept.count() == len(rows) - 8
    assert dc.contaminated(df, bench.limit(0)).collect() == [] and dc.contaminated(df.limit(0), bench).collect() == []
    assert dc.decontaminated(df, bench.limit(0)).count() == len(rows)
