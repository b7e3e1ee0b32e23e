import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cases import clashing, documents, same, texts
from wideloom.llm.packing import CapacityTree, packed, place, plan, sequences, token_pieces
from wideloom.llm.common import stored
from wideloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def test_tightest_capacity():
    rng = random.Random(1)
    tree, held = CapacityTree(100), [0] * 101
    for _ in range(500):
        c = rng.randint(0, 100)
        n = rng.choice([1, 2, -held[c]])
        held[c] += n
        tree.add(c, n)
        need = rng.randint(1, 100)
        assert tree.tightest(need) == next((k for k in range(need, 101) if held[k]), None)


@pytest.mark.parametrize("seed", range(20))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 64, 1024])
    counts = {rng.randint(1, window): rng.randint(1, 60) for _ in range(rng.randint(0, 70))}
    placed, seen = defaultdict(list), defaultdict(int)
    for s in plan(counts, window):
        assert s.first == seen[s.size]
        seen[s.size] += s.windows * s.per_window
        for w in range(s.windows):
            placed[s.window + w] += [(s.offset + k * s.size, s.size) for k in range(s.per_window)]
    assert dict(seen) == counts
    room = []  # plain best fit decreasing, one piece at a time
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            i = bisect.bisect_left(room, size)
            left = (room.pop(i) if i < len(room) else window) - size
            if left:
                bisect.insort(room, left)
    for pieces in placed.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= window
    assert sorted(window - sum(z for _, z in p) for p in placed.values() if sum(z for _, z in p) < window) == room


def check(rows, got, reference, window):
    ids = {i: reference(t) for i, t in enumerate(rows)}
    cover, slots = defaultdict(list), defaultdict(list)
    for r in got:
        part = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
        cover[r.doc_id].append((r.start, r.length))
        slots[r.sequence_id].append((r.offset, r.length))
    assert set(cover) == set(ids)
    for parts, size in [(c, len(ids[i])) for i, c in cover.items()] + [(s, None) for s in slots.values()]:
        at = 0
        for a, n in sorted(parts):
            assert a == at and n > 0
            at += n
        assert at == size if size is not None else at <= window


def test_round_trip(spark, reference):
    rows = texts(1) + ["<|endoftext|> is text", " " * 300, "x" * 5000, "漢字" * 900]
    check(rows, packed(documents(spark, rows)).collect(), reference, 1024)
    check(rows, packed(documents(spark, rows).repartition(7), window=64).collect(), reference, 64)


def test_sequences_hold_the_ids(spark, reference):
    rows = texts(2, 10)
    placed = place(stored(token_pieces(documents(spark, rows), window=128)), 128)
    whole = {r.sequence_id: r for r in sequences(placed, 128).collect()}
    for r in placed.collect():
        assert whole[r.sequence_id].ids[r.offset:r.offset + r.length] == reference(rows[r.doc_id])[r.start:r.start + r.length]
    for r in whole.values():
        assert len(r.ids) == (r.used if r.used & (r.used - 1) == 0 else 128)


def test_empty_repeated_and_extra(spark):
    assert packed(documents(spark, [])).collect() == []
    rows = [(5, "same text"), (5, "same text"), (None, None), (None, "other")]
    got = packed(documents(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.length) for r in got) == sorted((k or -1, r) for k, r in ((5, 3), (5, 3), (None, 1), (None, 2)))
    assert len({(r.sequence_id, r.offset) for r in got}) == 4
    some = documents(spark, texts(3, 8))
    assert same(packed(clashing(some)).collect(), packed(some).collect())


def test_query_gives_added_tokens_their_ids(spark, tmp_path):
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reference = lambda text: default.encode(text or "", add_special_tokens=False).ids + [0]
    rows = ["<|endoftext|>", "one <|endoftext|> two", "a  <|endoftext|><|endoftext|>  b\n", "<|endoftext| >", "<<|endoftext|>>",
            "é漢 \n <|endoftext|>\n\n" + "word " * 1500 + "<|endoftext|>", "<|ENDOFTEXT|>", "plain", "", None]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    check(rows, QUERIES["op6_best_fit_packing"](spark, str(tmp_path)).collect(), reference, 1024)
    assert reference(rows[0]) == [50256, 0]
