"""Nearest neighbours: rotation, recall against brute force, ties, odd vectors."""

import numpy as np
import pytest

from instrel.llm import op07_cross_polytope as op


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")


def brute(rows, k=20):
    valid = {i: np.array(v, dtype=float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for q in valid:
        if q % 20 == 0:
            near = sorted((-float((valid[q] * v).sum()), i) for i, v in valid.items() if i != q)
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def answers(frame, **how):
    out = {}
    for r in op.search(frame, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_rotation_keeps_lengths_and_probes_start_with_the_own_bucket():
    rows = np.random.default_rng(1).normal(size=(50, 64))
    assert np.allclose(np.linalg.norm(op._rotate(rows, (1, 2)), axis=1), np.linalg.norm(rows, axis=1))
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    how = op.hashing(3_000_000, 64, 1.0)
    assert len(how.axes) == 2
    assert (op.buckets(unit, how, True)[:, ::how.probes] == op.buckets(unit, how, False)).all()


@pytest.mark.parametrize("norms", [False, True])
def test_recall(spark, norms):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1500, 32))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    if norms:
        vectors *= rng.uniform(0.2, 3, size=(1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = frame_of(spark, rows)
    found = op.search(frame).persist()
    assert op.recall(frame, found) >= 0.9
    want, got = brute(rows), {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    assert all(len(x) == 20 and x == sorted(x, key=lambda p: (-p[1], p[0])) for x in got.values())


@pytest.mark.parametrize("fill, functions", [(1, 2), (0.5, 3)])
def test_recall_of_several_functions(spark, monkeypatch, fill, functions):
    monkeypatch.setattr(op, "FILL", fill)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(60, 16))
    vectors = centres[rng.integers(0, 60, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    assert len(op.hashing(3000, 16, 1.0).axes) == functions
    frame = frame_of(spark, [(i, v.tolist()) for i, v in enumerate(vectors)])
    assert op.recall(frame, op.search(frame).persist()) >= 0.9


def test_exact_search_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    vectors = np.round(rng.normal(size=(300, 8)), 1)
    frame = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(vectors)], "vec_id long, vector binary")
    queries = frame.where("vec_id % 3 = 0").withColumnRenamed("vec_id", "rep")
    whole = {tuple(r) for r in op.exact_search(queries, frame, 8, 5, 2).collect()}
    monkeypatch.setattr(op, "CHUNK", 7)
    assert {tuple(r) for r in op.exact_search(queries, frame, 8, 5, 3).collect()} == whole
    near = vectors @ vectors.T
    for rep in (0, 99, 297):
        want = sorted(range(300), key=lambda i: (-round(near[rep, i], 9), i))[:5]
        assert [i for r, i, _, _ in sorted(whole, key=lambda r: r[3]) if r == rep] == want


def test_few_odd_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 16)
    same = [0.6, 0.8, 0.0]
    rows = [(i, same) for i in range(0, 70)] + [(100, [1.0, 0.0, 0.0]), (101, [0.0, 0.0, 0.0]), (102, None), (103, [1.0, None, 0.0]),
            (104, [float("nan"), 1.0, 0.0]), (105, [1.0, 2.0]), (106, [-0.0, 1.0, 0.0]), (None, [1.0, 1.0, 1.0]), (100, [1.0, 0.0, 0.0])]
    got = answers(frame_of(spark, rows))
    assert got.keys() == {0, 20, 40, 60, 100}
    assert [i for i, _ in got[20]] == [i for i in range(22) if i != 20][:20]
    assert [i for i, _ in got[100]] == list(range(20))
    few = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])]
    assert answers(frame_of(spark, few)) == {0: [(1, 0.0), (2, -1.0)]}


def test_empty(spark):
    assert op.search(frame_of(spark, [])).count() == 0
