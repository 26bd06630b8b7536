"""Source divergence: the perfect hash, exact proportions, both ways of the second pass, SQL and brute force."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from instrel.llm import op12_divergence as op
from instrel.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300, 9000])
def test_hash_is_minimal_perfect_and_verified(n):
    terms = [f"t{i}é{i * i}".encode() for i in range(n)]
    sizes, packed, order = op.build(terms)
    assert sorted(order) == sorted(terms)
    table = op.PerfectHash(sizes, packed, order)
    assert table.slots(order, op.hash_terms(order)).tolist() == list(range(n))
    others = [f"other{i}".encode() for i in range(500)]
    assert (table.slots(others, op.hash_terms(others)) == -1).all()


def test_terms_of_equal_hash_are_listed(monkeypatch):
    monkeypatch.setattr(op, "xxh64_intdigest", lambda term, seed: 7)
    terms = [b"a", b"b", b"c"]
    table = op.PerfectHash(*op.build(terms))
    assert table.slots([b"c", b"x", b"a", b"b"], op.hash_terms([b""] * 4)).tolist() == [2, -1, 0, 1]


def test_proportions_are_exact():
    rng = random.Random(2)
    for total in (0, 5, 10**6, 9 * 10**15 - 10**6):
        kept = rng.randrange(1, 10**5)
        counts = [rng.randrange(total + 1) for _ in range(50)] + [0, total]
        got = op.proportions(np.array(counts, np.int64), total, kept)
        assert got.tolist() == [1 + 10**9 * (c + 2) // (total + 2 * kept) for c in counts]


def brute(rows, least=10, top=10):
    """``rows``: (lang, source, text)."""
    docs = [(l or "", s or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))) for l, s, t in rows]
    df, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        df[lang].update(set(words))
        groups[lang, source].update(words)
    out = []
    for lang in {k[0] for k in groups}:
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        own = {s: {t: c[t] for t in kept} for (l, s), c in groups.items() if l == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}
        p = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        ps, q = {s: p(c) for s, c in own.items()}, p(whole)
        for s in own:
            pairs = [(-sum(f(ps[s][t], ps[o][t]) for t in kept), o.encode(), o) for o in own if o != s]
            terms = [(-f(ps[s][t], q[t]), t.encode(), t) for t in kept if own[s][t] and ps[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, o, -v, r) for r, (v, _, o) in enumerate(found, 1)]
    return sorted(out)


def odd_rows():
    rng = random.Random(4)
    words = ["The", "the", "été", "日本語", "a1b", "x-y", "zz", "É", "straße", "one", "two", "three"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "é", "", None]), " ".join(rng.choices(words, k=rng.randrange(30)))) for _ in range(250)]
    return rows + [("fr", "only", "bonjour"), ("xx", "a", None), ("xx", "b", "rare words"), ("en", "bare", ""), ("en", "long", "the zz " * 30000)] + [rows[3]] * 5


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize(("shard", "block", "limit"), [(8192, 32, 1 << 26), (5, 2, 1 << 26), (5, 2, 0)])
def test_equals_brute_force(spark, shard, block, limit):
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, n int, term string").repartition(3)
    got = op.divergence(frame, shard=shard, block=block, broadcast_bytes=limit)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert found(got) == brute(rows)


def test_small_buffers_change_nothing(spark, monkeypatch):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, "lang string, source string, text string")
    monkeypatch.setattr(op, "DENSE", 3)
    monkeypatch.setattr(op, "COUNTED", 2)
    monkeypatch.setattr(op, "PIECE", 16)
    assert found(op.divergence(frame, shard=7)) == brute(rows)


def test_empty_table(spark):
    assert op.divergence(spark.createDataFrame([], "lang string, source string, text string")).count() == 0


def test_query_equals_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    got = queries.op12_divergence(spark, FOLDER)
    want = connection.execute(oracle.ORACLE["op12_divergence"])
    assert got.columns == [c[0] for c in want.description]
    assert found(got) == sorted(want.fetchall())
