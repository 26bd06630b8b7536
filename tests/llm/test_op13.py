"""Vector codes: rounds against plain k-means in Python integers, bounds that never lie and do save scans."""

import math
import random
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest

from instrel.llm import op13_vector_codes as op
from instrel.llm import queries


def brute(rows, entries=64, rounds=2):
    """``rows``: (vec_id, vector, label). Codes, errors and codebooks by the definition, in Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // 16) * 16
    kept = [(i, v + [0] * (width - len(v)), l) for i, v, l in kept]
    span = width // 16
    cut = lambda v, p: v[p * span:(p + 1) * span]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i2").tobytes()))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(16)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda part, book: min((far(part, e), j) for j, e in enumerate(book))
    for _ in range(rounds):
        held = [defaultdict(list) for _ in range(16)]
        for _, v, _ in kept:
            for p in range(16):
                held[p][nearest(cut(v, p), books[p])[1]].append(cut(v, p))
        for p in range(16):
            for j, parts in held[p].items():
                books[p][j] = [sum(c) // len(parts) for c in zip(*parts, strict=True)]
    out, totals = [], defaultdict(int)
    for i, v, l in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(16)]
        error = sum(d for d, _ in found)
        totals[l] += error
        out.append((i, "".join(f"{j:02x}" for _, j in found), error, l))
    digest = sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, totals[l], digest) for i, c, e, l in out), key=str)


def digest(spark, frame, entries=64, rounds=2):
    coded = op.compress(frame, entries, rounds)
    totals = defaultdict(int)
    rows = coded.rows.collect()
    for r in rows:
        totals[r.label] += r.error
    text = sha256(op.spelled(coded.codebooks).encode()).hexdigest()
    return sorted(((r.vec_id, bytes(r.code).hex(), r.error, totals[r.label], text) for r in rows), key=str), sum(r.rescans for r in rows)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def frame_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts)


def clustered(n=400, width=32, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, width))
    return [(i * 3 + 1, (centres[i % 20] + 0.05 * rng.normal(size=width)).astype(np.float32).tolist(), int(i % 5) or None) for i in range(n)]


@pytest.mark.parametrize(("entries", "rounds"), [(64, 2), (13, 4), (3, 1)])
def test_equals_brute_force(spark, entries, rounds):
    rows = clustered()
    got, _ = digest(spark, frame_of(spark, rows), entries, rounds)
    assert got == brute(rows, entries, rounds)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [random.Random(i).choice([-0.004, 0.0, 0.004, 0.5]) for _ in range(16)], i % 3) for i in range(90)]
    rows = good + [good[5]] * 4 + [
        (-9, None, 1), (-8, [nan] * 16, 1), (-7, [0.0] * 15 + [inf], 1), (-6, [None] + [0.5] * 15, 2),
        (5, [0.25] * 16, None), (None, [0.5] * 16, None), (200, [], 7), (201, [1.0] * 3, 7)]
    got, _ = digest(spark, frame_of(spark, rows))
    assert got == brute(rows)


def test_few_rows_and_none(spark):
    rows = clustered(5)
    assert digest(spark, frame_of(spark, rows))[0] == brute(rows)
    coded = op.compress(spark.createDataFrame([], SCHEMA))
    assert coded.rows.count() == 0 and op.spelled(coded.codebooks) == ""


def test_too_large_components_are_refused(spark):
    with pytest.raises(ValueError):
        op.compress(frame_of(spark, [(1, [1e30] * 16, 0)]))


def test_bounds_hold_and_net_moves_are_tighter():
    rng = np.random.default_rng(1)
    x = rng.integers(-500, 500, (300, 4))
    books = [rng.integers(-500, 500, (64, 4))]
    for _ in range(3):
        books.append(books[-1] + rng.integers(-30, 31, (64, 4)))
    books.append(books[0] + 1)  # back near the start: steps add up, the net move is small
    code, low, stamp = np.zeros(300, np.int64), np.zeros((300, 8), np.float16), np.zeros((300, 8), np.int64)
    scans = []
    for t in range(len(books)):
        code, low, stamp, least, scanned = op.assign(x, books[:t + 1], code, low, stamp)
        far = ((x[:, None] - books[t][None]) ** 2).sum(axis=2)
        assert (code == far.argmin(axis=1)).all() and (least == far.min(axis=1)).all()
        for g in range(8):
            for s in range(t + 1):
                then = np.sqrt(((x[:, None] - books[s][None, g * 8:g * 8 + 8]) ** 2).sum(axis=2).astype(float))
                then[np.arange(300)[:, None], np.arange(8)[None]] = np.where(
                    code[:, None] == np.arange(g * 8, g * 8 + 8)[None], np.inf, then)
                rows = stamp[:, g] == s
                now = np.sqrt(far[:, g * 8:g * 8 + 8].astype(float))
                now = np.where(code[:, None] == np.arange(g * 8, g * 8 + 8)[None], np.inf, now).min(axis=1)
                assert (low[rows, g] - op.net_moves(books[:t + 1])[s, g] <= now[rows] + 1e-6).all()
        scans.append(int(scanned.sum()))
    assert scans[0] == 300 * 8 and scans[-1] < 300 * 8 * 0.6
    steps = sum(op.net_moves(books[t:t + 2])[0] for t in range(len(books) - 1))
    assert (op.net_moves(books)[0] < steps / 5).all()


def test_rescans_are_saved(spark):
    rows = clustered()
    _, rescans = digest(spark, frame_of(spark, rows))
    assert rescans < 0.7 * len(rows) * 16 * 8 * 2


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    got = [tuple(r) for r in queries.op13_vector_codes(spark, folder).collect()]
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    assert sorted(got, key=str) == brute(rows)
