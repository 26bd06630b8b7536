"""Context-tree weighting: block probabilities, normalisation, brute force on a small corpus, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from instrel.llm import op02_context_tree as op


def test_log_gamma_and_estimator():
    x = np.array([0.5, 1.0, 1.5, 2.0, 10.25, 1e6])
    assert np.allclose(op.log_gamma(x), [math.lgamma(v) for v in x], rtol=0, atol=1e-9 * np.maximum(1, x))
    product = 1.0
    for zeros, ones, bit in ((0, 0, 1), (0, 1, 1), (0, 2, 0), (1, 2, 1)):
        product *= ((ones if bit else zeros) + 0.5) / (zeros + ones + 1)
    assert np.isclose(op.log_kt(np.array([1.0]), np.array([3.0]))[0], math.log(product))
    counts = [(0, 0), (70000, 2), (65535, 0), (65536, 1), (3, 65533), (10**9, 10**8)]
    want = [math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi) for a, b in counts]
    assert np.allclose(op.log_kt(*np.array(counts, float).T), want, rtol=1e-9, atol=1e-6)


class Brute:
    """The weighted tree by its definition, with dictionaries."""

    def __init__(self, texts):
        self.counts: dict = {}
        for data in texts:
            for i, byte in enumerate(data):
                context = self.context(data, i)
                for k in range(8):
                    bit = byte >> (7 - k) & 1
                    for d in range(op.DEPTH + 1):
                        self.counts.setdefault((context[:d], (1 << k) | byte >> (8 - k)), [0, 0])[bit] += 1
        self.children: dict = {}
        for context, prefix in self.counts:
            if context:
                self.children.setdefault((context[:-1], prefix), []).append((context, prefix))
        self.memo: dict = {}

    @staticmethod
    def context(data, i):
        """Nearest byte first."""
        return (data[:i][::-1] + b" " * op.DEPTH)[:op.DEPTH]

    def own(self, node):
        a, b = self.counts[node]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.memo:
            value = self.own(node)
            if len(node[0]) < op.DEPTH:
                value = np.logaddexp(value, sum(map(self.weighted, self.children[node]))) + math.log(.5)
            self.memo[node] = value
        return self.memo[node]

    def bit(self, context, prefix, bit, d=0):
        node = (context[:d], prefix)
        if node not in self.counts:
            return None
        estimate = (self.counts[node][bit] + .5) / (sum(self.counts[node]) + 1)
        deeper = self.bit(context, prefix, bit, d + 1) if d < op.DEPTH else None
        if deeper is None:
            return estimate
        share = math.exp(self.own(node) + math.log(.5) - self.weighted(node))
        return share * estimate + (1 - share) * deeper

    def code(self, data):
        total = 0.0
        for i, byte in enumerate(data):
            context = self.context(data, i)
            for k in range(8):
                p = self.bit(context, (1 << k) | byte >> (8 - k), byte >> (7 - k) & 1)
                total += math.log(.5 if p is None else p)
        return total


TEXTS = [
    (1, "the cat sat on the mat"), (2, "The dog sat on THE log"), (3, "a cat and a dog"), (4, None), (5, ""), (6, "là-bas été\tla\n"),
    (7, "catalogue catalogues dog"), (8, "unseen words here"), (9, "the the the the " * 40), (10, "x" * 300), (11, "mat"), (None, "the cat"),
    (2, "The dog sat on THE log"), (12, "mat the on sat cat the"), (13, "   "),
]


def expected(rows):
    """For each row: what is reported of it."""
    texts = []
    for i, text in rows:
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 1
        texts.append((i, held, [*(text or "").encode().lower().split(), op.END]))
    train = [w for _, held, tokens in texts if not held for w in tokens]
    tree, counts = Brute([b" ".join(tokens) for _, held, tokens in texts if not held]), Counter(train)
    n, v = len(train), len(counts)
    out = []
    for i, held, tokens in texts:
        base = sum(math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in tokens)
        score = tree.code(b" ".join(tokens)) / math.log(10)
        out.append((str(i), held, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 6), score))
    return sorted(out)


def reported(frame, **how):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), r.score)
                  for r in op.score_documents(frame, **how).collect())


def assert_equal(got, want):
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert [g[-1] for g in got] == pytest.approx([w[-1] for w in want], rel=1e-5)


@pytest.mark.parametrize("parts, block", [(1, 1 << 20), (3, 60), (2, 1)])
def test_against_brute_force(spark, monkeypatch, parts, block):
    monkeypatch.setattr(op, "PART", 40)
    frame = spark.createDataFrame([(*r, "x") for r in TEXTS], "doc_id long, text string, block string").coalesce(parts).repartition(parts)
    want = expected(TEXTS)
    assert {w[1] for w in want} == {True, False}
    assert_equal(reported(frame, block_bytes=block), want)


def test_the_order_of_words_counts():
    want = {w[0]: w for w in expected(TEXTS)}
    assert want["1"][5] == want["12"][5] and abs(want["1"][6] - want["12"][6]) > 0.5


def test_held_out_texts_score_above_words_alone(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sums = op.score_documents(frame).where("held_out").selectExpr("sum(score) as score", "sum(base_score) as base").first()
    assert sums.score > sums.base


def test_more_buckets_change_nothing(spark, monkeypatch):
    frame = spark.createDataFrame(TEXTS, "doc_id long, text string")
    monkeypatch.setattr(op, "BUCKET_BYTES", 100)
    monkeypatch.setattr(op, "BUCKETS", 3)
    monkeypatch.setattr(op, "HELD", 10)
    assert_equal(reported(frame), expected(TEXTS))


def test_bytes_sum_to_one():
    grams, counts = op._distinct(op.grams_of([op.coded(t.split()) for t in (b"abra cadabra", b"abracadabra bra", b"bra")]))
    for context in {int(g) >> 8 for g in grams}:
        asked = np.array([context << 8 | byte for byte in range(256)], dtype=np.uint64)
        every, sums = op.add_up(np.concatenate([grams, asked]), np.concatenate([counts, np.zeros(256, np.int64)]))
        levels = op.subtree_levels(every, sums)
        mixed, level = op.mix_subtrees(every, levels), levels[-1]
        keys, where = np.unique(level.keys & ((1 << 8 * op.NEAR) - 1), return_inverse=True)
        top = op.Top(keys, *(np.bincount(where, x, len(keys)) for x in (level.zeros, level.ones, level.weighted)))
        code = top.log_probability(every, mixed)[np.searchsorted(every, asked)]
        assert np.exp(code).sum() == pytest.approx(1)


def test_numbers_come_back_packed():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 56, n).astype(np.uint64))
        assert (op.unpacked_keys(op.packed_keys(keys)) == keys).all()
        values = rng.normal(size=n).astype("<f4")
        assert (op.unpacked(op.packed(values), "<f4") == values).all()


def test_repeats_and_empty(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "b")]
    out = op.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in out) == [(1, 4), (1, 4), (2, 2)]
    assert op.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_codes_and_tokens_of_places():
    """Sums of codes gram by gram, and tokens one by one; equal places of the upper bits may mix."""
    rng = np.random.default_rng(7)
    texts = [op.coded([bytes(rng.integers(97, 100, rng.integers(1, 6)).astype(np.uint8)) for _ in range(rng.integers(0, 40))]) for _ in range(300)]
    known = op.distinct_grams(texts)
    assert known.tolist() == op.gram_counts(texts, [True] * len(texts))[0].tolist()
    codes = rng.random(len(known)).astype(np.float32)
    of = dict(zip(known.tolist(), codes.tolist(), strict=True))
    want = [sum(of[g] for g in op.grams_of([t]).tolist()) for t in texts]
    assert np.allclose(op.code_sums(texts, known, codes), want, rtol=1e-12)
    words, numbers, lengths = op.tokens_of(texts)
    assert len(set(words)) == len(words) and lengths.tolist() == [len(t.split(b" ")) for t in texts]
    assert [words[i] for i in numbers.tolist()] == [w for t in texts for w in t.split(b" ")]
