"""SimHash: the code's guarantee, links against brute force, odd rows."""

import random
from itertools import combinations

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from instrel.llm import op05_simhash as op


def test_code_keys_meet_within_two_bits():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 4000)
    own = op.code_keys(words)
    assert (op.syndrome((own << 11) | 0) >= 0).all()
    for errors in (1, 2):
        for _ in range(20):
            flips = np.array([sum(1 << b for b in rng.choice(23, errors, replace=False)) for _ in words])
            other = op.code_keys(words ^ flips)
            assert (own[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()


def test_every_syndrome_and_error_pattern():
    """The guarantee depends on the syndrome and the error alone, so this is all of it."""
    leaders = op.error_patterns()[:, 0]
    own = op.code_keys(leaders)
    for errors in (1, 2):
        for some in combinations(range(23), errors):
            other = op.code_keys(leaders ^ sum(1 << b for b in some))
            assert (own[:, :, None] == other[:, None, :]).any(axis=(1, 2)).all()


def brute(text, k=3):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", low)
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    ids = sorted(i for i in prints if i is not None)
    root = {i: i for i in ids}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in combinations(ids, 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 2:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("small", [0, 16])
def test_links_equal_all_pairs(spark, small):
    rng = random.Random(small)
    prints = set()
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 40)):
            prints.add(x)
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.7:
                x ^= 1 << rng.randrange(64)
    prints = dict(enumerate(sorted(prints)))
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in prints.items()]
    nodes = spark.createDataFrame(signed, "node long, fp long")
    found = {r.node: r.component for r in op.components(op.links(nodes, small)).collect()}
    assert {i: found.get(i, i) for i in prints} == brute_components(prints)


def test_near_duplicates_of_odd_rows(spark):
    base = "The quick brown fox Jumps over É the lazy dog " * 3
    rows = [(5, base), (2, base), (9, None), (4, ""), (7, " \n"), (8, "one"), (None, base), (3, "one two"), (2, base),
            (11, "x " * 70000), (12, "a b c d e")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int")
    out = op.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    prints = {i: brute(t) for i, t in rows}
    want = brute_components({i: p for i, p in prints.items() if i is not None})
    for r in out:
        assert r.fingerprint == f"{prints[r.doc_id]:016x}"
        assert r.component_id == want[5 if r.doc_id is None else r.doc_id]


def brute_kept(rows):
    """Positions of the rows that stay; ``rows``: (doc_id, text). Of equal rows the first."""
    prints = [brute(t) for _, t in rows]
    root = brute_components(dict(enumerate(prints)))
    groups = {}
    for at, (i, t) in enumerate(rows):
        key = (i is None, i or 0, xxh64_intdigest((t or "").encode(), 42) if t is not None else 42)
        signed = key[2] - (1 << 64) if key[2] >> 63 else key[2]
        groups.setdefault(root[at], []).append((key[:2], signed, at))
    return sorted(min(members)[2] for members in groups.values())


def near_copies(rng, n=40):
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 8))) for _ in range(3000)]
    rows = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randrange(100, 400))]
        rows.append((i, " ".join(own)))
        for k in range(rng.randrange(4)):
            near = list(own)
            near[rng.randrange(len(near))] = rng.choice(words)
            rows.append((1000 - 10 * i - k, " ".join(near).title()))
    rng.shuffle(rows)
    return rows


def test_keep_one_equals_brute_force(spark):
    rows = near_copies(random.Random(3))
    rows += [(5000 + i, rows[0][1]) for i in range(300)]
    frame = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, key string, fp int")
    kept = op.keep_one(frame)
    assert kept.columns == frame.columns
    want = brute_kept(rows)
    assert 40 <= len(want) < len(rows) - 300
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(rows[at] for at in want)


def test_keep_one_of_odd_rows(spark):
    base, other = "The quick brown fox Jumps over É the lazy dog " * 3, "one two three four"
    rows = [(5, base), (2, base), (9, None), (4, ""), (7, " \n"), (None, base), (2, base), (3, other), (3, "some thing else here"),
            (3, other), (None, "alone"), (None, "alone"), (6, "some thing else here"), (11, "x " * 70000)]
    frame = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, row string")
    got = sorted(((r.doc_id, r.text) for r in op.keep_one(frame).collect()), key=str)
    assert got == sorted((rows[at] for at in brute_kept(rows)), key=str)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_duplicates(docs).count() == 0
    assert op.keep_one(docs).count() == 0
