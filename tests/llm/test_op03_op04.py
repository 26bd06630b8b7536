"""Classifiers: held-out accuracy on the given tables, calibration, odd rows."""

import zlib

import numpy as np
import pytest

from instrel.llm import op03_quality as quality
from instrel.llm import op04_toxicity as toxicity
from instrel.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def odd(spark):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "word " * 5), (4, "x " * 60000), (5, "   ")]
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_held_out_accuracy_and_odd_rows(spark, name):
    docs, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    if name == "quality":
        model, score = quality.fit_quality(docs, labels), quality.score_quality
    else:
        model, score = toxicity.fit_toxicity(docs, labels), toxicity.score_toxicity
    got = score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got)
    right = np.mean([r.predicted == r[name] for r in held])
    common = max(np.mean([r[name] for r in held]), 1 - np.mean([r[name] for r in held]))
    assert len(held) > 50 and right >= max(0.95, common)
    out = score(odd(spark), model).collect()
    assert len(out) == 7 and len({r.score for r in out if r.doc_id in (1, 2)}) == 1
    assert not any(r.held_out for r in out if r.doc_id is None)
    assert score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_one_class_or_no_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(i, 1, 1) for i in range(30)] + [(None, 0, 0), (3, None, None)], none.schema)
    assert {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, none)).collect()} == {0.5}
    assert min(r.score for r in quality.score_quality(docs, quality.fit_quality(docs, one)).collect()) > 0.8
    assert {r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()} == {0.5}
    assert min(r.score for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, one)).collect()) > 0.8


def test_an_id_of_many_rows_counts_once(spark):
    docs = spark.createDataFrame([(1, f"text {i % 3}") for i in range(500)] + [(2, "b"), (2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    chosen = spark.createDataFrame([(1, 1), (2, 0), (4, 1)], "doc_id long, label int")
    found = {r.doc_id: r.text for r in quality.labelled_texts(docs, chosen).collect()}
    assert found.keys() == {1, 2} and found[1] in {"text 0", "text 1", "text 2"}
    assert {r.doc_id: r.text for r in quality.labelled_texts(docs.repartition(5), chosen).collect()} == found


def objective(rows, labels, scale, weights, bias, cost):
    """What the linear model minimises."""
    y, share = np.where(labels == 1, 1.0, -1.0), labels.mean()
    bound = cost * np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    loss = sum(c * max(0.0, 1 - t * ((weights[r] * scale[r]).sum() * len(r) ** -0.5 + bias)) for r, t, c in zip(rows, y, bound, strict=True))
    return 0.5 * ((weights**2).sum() + bias**2) + loss


def plain_dual(rows, labels, scale, cost, steps=30000):
    """The largest value of the dual by projected gradient steps on a dense matrix."""
    y, share = np.where(labels == 1, 1.0, -1.0), labels.mean()
    bound = cost * np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    x = np.zeros((len(rows), len(scale) + 1))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] * len(r) ** -0.5
        x[i, -1] = 1.0
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha, rate = np.zeros(len(rows)), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(steps):
        alpha = np.clip(alpha - rate * (q @ alpha - 1), 0, bound)
    return alpha.sum() - 0.5 * alpha @ q @ alpha


def test_descent_solves_the_dual():
    """No duality gap is left: the model's objective is the largest value of the dual."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 12)) for _ in range(80)]
    labels = np.array([int((r < 15).sum() + rng.random() * 3 > 5) for r in rows])
    scale = rng.normal(size=64)
    found, bias = quality._descend(rows, labels, scale, 1.0, 2000, 1)
    value, best = objective(rows, labels, scale, found / scale, bias, 1.0), plain_dual(rows, labels, scale, 1.0)
    assert best - 1e-6 <= value <= best * 1.002


def test_ratios_are_those_of_counts():
    rows, labels = [np.array([0, 2]), np.array([2]), np.array([1, 2, 3])], np.array([1, 0, 0])
    got = quality._ratios(rows, labels, 4, 1.0)
    one, none = [2 / 6, 1 / 6, 2 / 6, 1 / 6], [1 / 8, 2 / 8, 3 / 8, 2 / 8]
    assert np.allclose(got, [np.log(a / b) for a, b in zip(one, none, strict=True)])


def test_isotonic_is_the_best_rising_curve():
    """Against the greatest of least means, point by point."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 60):
        margins, labels = rng.permutation(n).astype(float), rng.integers(0, 2, n)
        sorted_labels = labels[np.argsort(margins)].astype(float)
        fitted = [max(min(sorted_labels[j:k + 1].mean() for k in range(i, n)) for j in range(i + 1)) for i in range(n)]
        cuts = [0, *(i for i in range(1, n) if fitted[i] > fitted[i - 1] + 1e-12), n]
        want = [((sorted_labels[a:b].sum() + 0.1) / (b - a + 0.2), np.arange(a, b).mean()) for a, b in zip(cuts, cuts[1:], strict=False)]
        x, y = toxicity.isotonic(margins, labels)
        assert np.allclose(x, [m for _, m in want]) and np.allclose(y, np.maximum.accumulate([v for v, _ in want]))


def plain_boost(x, y, rounds, depth, rate, bins, leaf):
    """Margins of boosted trees, each cut tried by itself."""
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    margin = [np.log(share / (1 - share))] * len(x)
    edges = [sorted(set(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1]))) for f in range(x.shape[1])]
    for _ in range(rounds):
        p = [1 / (1 + np.exp(-m)) for m in margin]
        g, h = [t - q for t, q in zip(y, p, strict=True)], [q * (1 - q) for q in p]
        def grow(some, level):
            if level == depth:
                value = rate * sum(g[i] for i in some) / (sum(h[i] for i in some) + 1) if some else 0.0
                return [(i, value) for i in some]
            best, left, right = 1e-6, some, []
            if len(some) >= 2 * leaf:
                whole = sum(g[i] for i in some) ** 2 / (sum(h[i] for i in some) + 1)
                for f in range(x.shape[1]):
                    gains = []
                    for cut in edges[f]:
                        a, b = [i for i in some if x[i, f] <= cut], [i for i in some if x[i, f] > cut]
                        gain = sum(sum(g[i] for i in s) ** 2 / (sum(h[i] for i in s) + 1) for s in (a, b)) - whole
                        gains.append((0.0 if min(len(a), len(b)) < leaf else gain, a, b))
                    top = max(range(len(gains)), key=lambda k: (gains[k][0], -k)) if gains else None
                    if top is not None and gains[top][0] > best:
                        best, left, right = gains[top]
            return grow(left, level + 1) + grow(right, level + 1)
        for i, value in grow(list(range(len(x))), 0):
            margin[i] += value
    return np.array(margin)


def test_boosting_equals_plain_trees():
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(70, 4)), 2)
    x[:, 3] = 1.0
    y = ((x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=70) * 0.3) > 0).astype(float)
    got = toxicity.boost(x, y, rounds=6, depth=3, rate=0.3, bins=8, leaf=3.0)
    assert np.allclose(got.margin(x), plain_boost(x, y, 6, 3, 0.3, 8, 3.0), atol=1e-9)


def test_disguised_words_and_second_person():
    make = toxicity.Dense({"widiot": 3.0, "sstup": 2.0})
    names = dict(zip(toxicity.NAMES, make.of("You are an 1d10t and an i.d.i.o.t , STUPIDO! i d i o t"), strict=True))
    assert names["disguised"] > 0 and names["stems"] > 0 and names["second"] > 0 and names["near"] > 0 and names["shouted"] > 0
    assert not make.of("").any()
