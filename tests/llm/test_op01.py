"""Sharding against the tree by its definition, growth, slots, odd rows."""

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash

from instrel.llm import op01_sharding as op


def rows_of(spark, n=3000):
    return [(i, f"text é {i % 700}" if i % 50 else None) for i in range(n)]


def test_law_slots_and_checksums(spark):
    rows = rows_of(spark) + [(7, "text é 7")] * 40 + [(None, "x"), (None, None), (9, "")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    out = op.shard_documents(frame, [1.0] * 24).collect()
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, 8 + len((t or "").encode()), None if t is None else zlib.crc32(t.encode())) for i, t in rows)
    slots = {}
    for r in out:
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24) and r.law == "key"
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in out if r.doc_id == 7}) == 1
    assert all(60 < c < 220 for c in Counter(r.shard for r in out if r.doc_id != 7).values())


def variate(key, level, node, weight):
    value = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    for part in (level, node):
        value = xxhash.xxh64_intdigest(struct.pack("<i", part), value)
    return -math.log(((value >> 11) + 0.5) * 2.0**-53) / weight


def by_hand(key, weights, base=None):
    """The descent in plain Python."""
    places = [p for p in op.layout(len(weights), base) if weights[p[2]] > 0]
    for level in range(3):
        sums = Counter()
        for p in places:
            sums[p[level]] += weights[p[2]]
        chosen = min(sums, key=lambda node: variate(key, level, node, sums[node])) if len(sums) > 1 else min(sums)
        places = [p for p in places if p[level] == chosen]
    return places[0][2]


def shards(spark, *trees, n=4000):
    """For each key its shard in each tree of ``(weights, base)``."""
    frame = spark.range(n)
    for i, (weights, base) in enumerate(trees):
        frame = op.descend(frame, "id", weights, f"s{i}", base)
    return [tuple(r) for r in frame.collect()]


@pytest.mark.parametrize("weights, base", [([1.0] * 24, None), ([1.0] * 25, 24), ([1.0, 2.0, 0.0, 3.0, 1.0, 0.5, 0.0, 0.0, 0.0, 4.0, 1.0], 9), ([3.0], None)])
def test_every_shard_is_that_of_the_descent(spark, weights, base):
    found = shards(spark, (weights, base), n=1500)
    assert all(shard == by_hand(key, weights, base) for key, shard in found)


def test_shares_are_those_of_the_weights(spark):
    weights = [1.0, 2.0, 0.0, 3.0, 1.0, 5.0, 1.0, 1.0, 2.0, 4.0]
    counts = Counter(s for _, s in shards(spark, (weights, None), n=20000))
    for s, w in enumerate(weights):
        mean = 20000 * w / sum(weights)
        assert abs(counts[s] - mean) <= 5 * math.sqrt(mean + 1)


def test_more_shards_take_keys_only_into_themselves(spark):
    found = shards(spark, ([1.0] * 24, 24), ([1.0] * 25, 24), ([1.0] * 25 + [2.0], 24))
    assert all(b in (a, 24) and c in (b, 25) for _, a, b, c in found)
    assert 80 < sum(a != b for _, a, b, _ in found) < 260 and sum(b != c for _, _, b, c in found) > 150


def test_a_swap_inside_a_rack_moves_no_key_across_racks(spark):
    before, after = [1.0] * 24, [1.0] * 24
    after[1], after[2] = 1.75, 0.25
    found = shards(spark, (before, None), (after, None))
    moved = [(a, b) for _, a, b in found if a != b]
    assert moved and all(a // 4 == b // 4 == 0 for a, b in moved)


def test_a_swap_inside_a_region_moves_no_key_across_regions(spark):
    before, after = [1.0] * 24, [1.0] * 24
    after[8], after[13] = 0.0, 2.0
    found = shards(spark, (before, None), (after, None))
    moved = [(a, b) for _, a, b in found if a != b]
    assert moved and all(a // 8 == b // 8 == 1 for a, b in moved)


def test_empty(spark):
    assert op.shard_documents(spark.createDataFrame([], "doc_id long, text string"), [1.0] * 24).count() == 0
