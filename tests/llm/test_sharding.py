import zlib

import numpy as np
import pytest

from cases import clashing, documents, same, texts
from wideloom.llm import sharding


def walk(arc_rows, owners, room):
    """Row by row: each arc's rows to their shard while it has room, then the rest clockwise, in rounds."""
    room, load, place = list(room), [0] * len(room), {}
    waiting = [(arc, i, arc) for arc in sorted(arc_rows) for i in range(arc_rows[arc])]
    while waiting:
        over = []
        for arc, i, at in waiting:
            if room[owners[at]]:
                place[arc, i] = (owners[at], load[owners[at]])
                load[owners[at]] += 1
                room[owners[at]] -= 1
            else:
                over.append((arc, i, at))
        waiting = []
        for arc, i, at in over:
            at = (at + 1) % len(owners)
            while not room[owners[at]]:
                at = (at + 1) % len(owners)
            waiting.append((arc, i, at))
    return place


@pytest.mark.parametrize("seed", range(8))
def test_assignment_against_single_steps(seed):
    rng = np.random.default_rng(seed)
    shards = int(rng.integers(1, 6))
    _, owners = sharding.ring(shards, 4)
    counts = {a: int(rng.integers(1, 30)) for a in range(len(owners)) if rng.random() < 0.7}
    counts[0] = 200
    total = sum(counts.values())
    for slack in (0.0, 0.3):
        room = sharding.bounds(total, shards, slack)
        runs = sharding.assign(counts, owners, room)
        loads = [0] * shards
        for arc, parts in runs.items():
            ends = [p[0] for p in parts[1:]] + [counts[arc]]
            for (first, shard, slot), end in zip(parts, ends):
                loads[shard] += end - first
        assert sum(loads) == total and all(a <= b for a, b in zip(loads, room))
        if slack == 0:
            assert loads == room
        want = {}
        for s, _ in walk(counts, owners.tolist(), room).values():
            want[s] = want.get(s, 0) + 1
        assert [want.get(s, 0) for s in range(shards)] == loads


def test_adding_a_shard_leaves_other_points(spark):
    a, b = sharding.ring(8), sharding.ring(9)
    old = dict(zip(a[0].tolist(), a[1].tolist()))
    assert all(old.get(p, 8) == s for p, s in zip(b[0].tolist(), b[1].tolist()))
    # Unbounded, keys only move to the new shard; with tight bounds most keys still stay.
    df = documents(spark, [(i, f"text {i}") for i in range(4000)])
    at = [{r.doc_id: r.shard for r in sharding.shard_documents(df, n).collect()} for n in (8, 9)]
    assert sum(at[0][k] != at[1][k] for k in at[0]) < 0.5 * len(at[0])


def check(spark, rows, shards=8):
    got = sharding.shard_documents(documents(spark, rows), shards).collect()
    assert same([(r.doc_id, r.size, r.text_crc32) for r in got],
                [(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows])
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(shards)}
    sizes = [len(s) for s in slots.values()]
    assert all(s == list(range(len(s))) for s in slots.values()) and max(sizes) - min(sizes) <= 1
    return got


def test_counts_slots_and_sizes(spark):
    check(spark, list(enumerate(texts(1, 200))))
    check(spark, [(None, None), (1, ""), (1, ""), (None, "x"), (2, "é")])
    check(spark, [(1, "one")])


def test_a_third_of_the_rows_are_copies(spark):
    rows = [(i, "copy") for i in range(1500)] + [(5000 + i, f"text {i}") for i in range(3000)]
    check(spark, rows)
    few = documents(spark, rows[1490:])  # with room, copies stay in one shard
    assert len({r.shard for r in sharding.shard_documents(few, 8, slack=0.5).collect() if r.doc_id < 1500}) == 1


def test_empty_extra_and_stable(spark):
    assert sharding.shard_documents(documents(spark, [])).collect() == []
    df = documents(spark, texts(2, 60))
    once = sharding.shard_documents(df).collect()
    assert same(once, sharding.shard_documents(clashing(df).repartition(5)).collect())
