"""Toxicity: boosted trees over a few dense features, with isotonic calibration.

A lexicon of words and word stems is learned first: those that toxic training
documents hold far more often than others. Features of a text are densities of
lexicon words, stems and disguised lexicon words, how near second-person words
stand to them, capitals, punctuation, disguised spelling and length. Trees are
boosted on logistic loss over binned features, and predictions on folds left out
give the isotonic curve that maps margins to probabilities. Features of training
rows use the lexicon of the other fold, so that no row finds words learned from itself.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instrel.llm.common import held_out, key_and_text, sized_batches, stored
from instrel.llm.op03_quality import labelled_sample, labelled_texts

#: Labelled rows fitted on, about; bounds what the driver gathers.
SAMPLE = 5000
#: Entries of a lexicon at most, the strongest ones.
LEXICON = 3000
#: Toxic documents an entry must occur in, and its least log ratio.
LEAST, RATIO = 5, 2.0
NEAR = 5
FOLDS = 2
#: Classes of words remembered by a task.
REMEMBERED = 200_000

# Fixed list: second-person words of English, German, French, Spanish, Italian and Portuguese.
SECOND_PERSON = set(
    "you your yours yourself ye u ur du dich dir dein deine deinen ihr euch euer sie ihnen tu te toi ton ta tes vous votre vos "
    "usted ustedes tú ti tus vosotros os voi voce você".split())
# Fixed table: signs that stand for letters.
_DISGUISES = str.maketrans("013457@$!|", "oieastasii")
_EDGE = "\"'`.,;:!?()[]{}<>|*#$%&-_~…»«“”’"
_INSIDE = re.compile(r"(?<=[^\W\d_])[^\w\s]+(?=[^\W\d_])|_")
_REPEAT = re.compile(r"(.)\1{2,}")

WORD, STEM, DISGUISED, SECOND, CAPITAL, ODD, SINGLE = 1, 2, 4, 8, 16, 32, 64
NAMES = (
    "words", "stems", "weight", "hits", "distinct", "second", "near", "capitals", "shouted", "marks", "signs", "odd", "disguised", "length")


def entries(text: str) -> set[str]:
    """Lexicon entries of a text: ``w`` with each word, ``s`` with each longer word's first 4, 5 and 6 letters."""
    found = set()
    for raw in set(text.lower().split()):
        word = raw.strip(_EDGE)
        if word:
            found.add("w" + word)
            found.update("s" + word[:k] for k in (4, 5, 6) if len(word) > k)
    return found


class Dense:
    """``of(text)`` gives the feature row."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, tuple[int, float]] = {}

    def _lookup(self, word: str) -> float | None:
        return self.lexicon.get("w" + word)

    def kind(self, raw: str) -> tuple[int, float]:
        """Classes of a word as bits, and its weight in the lexicon."""
        flags, weight = 0, 0.0
        word = raw.strip(_EDGE)
        low = word.lower()
        if low in SECOND_PERSON:
            flags |= SECOND
        if len(word) > 1 and word.isupper():
            flags |= CAPITAL
        if len(word) == 1:
            flags |= SINGLE
        own = self._lookup(low)
        if own is not None:
            flags, weight = flags | WORD, own
        else:
            stems = [w for w in (self.lexicon.get("s" + low[:k]) for k in (4, 5, 6) if len(low) > k) if w is not None]
            if stems:
                flags, weight = flags | STEM, max(stems)
        letters = any(c.isalpha() for c in low)
        if letters and (any(c in "013457@$!|*" for c in low) or _INSIDE.search(low) or _REPEAT.search(low)):
            flags |= ODD
            core = raw.lower().strip("\"'.,;:?()[]{}<>#%&-_~").translate(_DISGUISES)
            for form in (core, _INSIDE.sub("", core), _REPEAT.sub(r"\1", _INSIDE.sub("", core)), _REPEAT.sub(r"\1\1", core)):
                found = self._lookup(form.strip(_EDGE))
                if own is None and found is not None:
                    flags, weight = flags | DISGUISED, max(weight, found)
        return flags, weight

    def of(self, text: str) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        words = text.split()
        n = len(words)
        row = np.zeros(len(NAMES))
        if not n:
            return row
        counts = Counter(words)
        for word in counts:
            if word not in known:
                known[word] = self.kind(word)
        flags = np.fromiter((known[w][0] for w in words), dtype=np.uint8, count=n)
        hit = flags & (WORD | STEM | DISGUISED) > 0
        hits = int(hit.sum())
        found = {w: c for w, c in counts.items() if known[w][0] & (WORD | STEM | DISGUISED)}
        second = flags & SECOND > 0
        near = 0
        if hits and second.any():
            at = np.flatnonzero(second)
            places = np.flatnonzero(hit)
            right = np.searchsorted(at, places)
            near = int(((places - at[np.maximum(right - 1, 0)] <= NEAR) & (right > 0)
                        | (at[np.minimum(right, len(at) - 1)] - places <= NEAR) & (right < len(at))).sum())
        # Letters spelled apart: runs of four and more single letters that make a lexicon word.
        spelled = 0
        if (flags & SINGLE > 0).any():
            for run in re.finditer(r"(?:(?<=\s)|^)\w(?:\s\w){3,}(?=\s|$)", text):
                spelled += self._lookup(re.sub(r"\s", "", run[0]).lower().translate(_DISGUISES)) is not None
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        upper = int(((raw >= 65) & (raw <= 90)).sum())
        lower = int(((raw >= 97) & (raw <= 122)).sum())
        marks = int(((raw == 33) | (raw == 63)).sum())
        signs = int(((raw > 32) & (raw < 127)).sum()) - upper - lower - int(((raw >= 48) & (raw <= 57)).sum()) - marks
        row[:] = (
            (flags & WORD > 0).sum() / n, (flags & STEM > 0).sum() / n, sum(known[w][1] * c for w, c in found.items()) / n,
            np.log1p(hits + spelled), np.log1p(len(found)), second.sum() / n, near / max(1, hits),
            upper / max(1, upper + lower), (flags & CAPITAL > 0).sum() / n, marks / len(raw), signs / len(raw),
            (flags & ODD > 0).sum() / n, ((flags & DISGUISED > 0).sum() + spelled) / n, np.log1p(n))
        return row


class Trees(NamedTuple):
    """Trees of fixed depth as arrays: at each inner node a feature and a cut, at each leaf a value."""

    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        at_rows = np.arange(len(rows))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            while node.size and node[0] < len(features):
                node = 2 * node + 1 + (rows[at_rows, features[node]] > cuts[node])
            total += leaves[node - len(features)]
        return total


def boost(rows: np.ndarray, labels: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, leaf: float = 3.0) -> Trees:
    """Second-order boosting on logistic loss; cuts are quantiles of each feature, the best gain wins, lower features first on ties."""
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(edges[f], rows[:, f], side="left") for f in range(rows.shape[1])], axis=1)
    inner = 2**depth - 1
    features = np.zeros((rounds, inner), dtype=np.int64)
    cuts = np.full((rounds, inner), np.inf)
    leaves = np.zeros((rounds, inner + 1))
    margin = np.full(len(rows), base)
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = labels - p, p * (1 - p)
        node = np.zeros(len(rows), dtype=np.int64)
        for level in range(depth):
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                some = np.flatnonzero(node == at)
                best = 1e-6
                if len(some) >= 2 * leaf:
                    total_g, total_h = g[some].sum(), h[some].sum()
                    for f in range(rows.shape[1]):
                        if not len(edges[f]):
                            continue
                        gs = np.cumsum(np.bincount(binned[some, f], g[some], len(edges[f]) + 1))[:-1]
                        hs = np.cumsum(np.bincount(binned[some, f], h[some], len(edges[f]) + 1))[:-1]
                        ns = np.cumsum(np.bincount(binned[some, f], minlength=len(edges[f]) + 1))[:-1]
                        gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                        gain[(ns < leaf) | (len(some) - ns < leaf)] = 0
                        k = int(gain.argmax())
                        if gain[k] > best:
                            best, features[r, at], cuts[r, at] = gain[k], f, edges[f][k]
                node[some] = 2 * at + 1 + (rows[some, features[r, at]] > cuts[r, at])
        which = node - inner
        leaves[r] = rate * np.bincount(which, g, inner + 1) / (np.bincount(which, h, inner + 1) + 1)
        margin += leaves[r][which]
    return Trees(features, cuts, leaves, base)


def isotonic(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing curve through smoothed block means, by pooling neighbours that fall."""
    order = np.argsort(margins, kind="stable")
    blocks: list[list[float]] = []  # sum, count, sum of margins
    for m, y in zip(margins[order], labels[order], strict=True):
        blocks.append([float(y), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, t = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + t]
    x = np.array([t / n for _, n, t in blocks])
    y = np.array([(s + 0.1) / (n + 0.2) for s, n, _ in blocks])
    return x, np.maximum.accumulate(y)


class Model(NamedTuple):
    lexicon: dict[str, float]
    trees: Trees
    curve: tuple[np.ndarray, np.ndarray]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.trees.margin(rows), *self.curve) if len(rows) else np.zeros(0)


def _lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """A lexicon without each fold's rows, and last that of all rows. The counts are Spark's; ``LEXICON`` entries reach the driver each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches):
            sums: Counter = Counter()
            for text, label, fold in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "fold")), strict=True):
                sums.update((e, fold, label) for e in entries(text or ""))
            keys = list(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.int32()), pa.array([sums[k] for k in keys], pa.int64())], ["entry", "fold", "label", "docs"])

    counted = sample.mapInArrow(count, "entry string, fold int, label int, docs bigint")
    cells = [(f, y) for f in range(FOLDS) for y in (0, 1)]
    wide = counted.groupBy("entry").agg(*(
        F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("label") == y), F.col("docs"))), F.lit(0)).alias(f"d{f}{y}") for f, y in cells))
    wide = stored(wide.where(sum((F.col(f"d{f}1") for f in range(FOLDS)), F.lit(0)) >= LEAST), "entries")
    totals = {(r.fold, r.label): r.n for r in sample.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    found = []
    for left_out in [*range(FOLDS), None]:
        use = [f for f in range(FOLDS) if f != left_out]
        docs = [sum((F.col(f"d{f}{y}") for f in use), F.lit(0)) for y in (0, 1)]
        sizes = [sum(totals.get((f, y), 0) for f in use) for y in (0, 1)]
        weight = F.log((docs[1] + 0.5) / (sizes[1] + 1.0)) - F.log((docs[0] + 0.5) / (sizes[0] + 1.0))
        strong = wide.select("entry", docs[1].alias("docs"), weight.alias("weight")).where((F.col("docs") >= LEAST) & (F.col("weight") >= RATIO))
        found.append({r.entry: r.weight for r in strong.orderBy(F.desc(F.col("docs") * F.col("weight")), "entry").limit(LEXICON).collect()})
    return found


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", remainder: int = 0, sample: int = SAMPLE) -> Model:
    """A model of about ``sample`` labelled rows that are not held out. With one class only, its smoothed share is every score.

    A document of several rows counts once.
    """
    chosen = labelled_sample(labels, label_col, remainder, sample)
    rows = stored(labelled_texts(docs, chosen).withColumn(
        "fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")), "labelled")
    lexicons = _lexicons(rows)
    sent = docs.sparkSession.sparkContext.broadcast(lexicons)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers = [Dense(lexicon) for lexicon in sent.value]
        for batch in batches:
            found = [makers[f].of(t or "").tolist() for t, f in zip(batch.column("text").to_pylist(), batch.column("fold").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("fold"), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "label", "fold", "row"])

    got = rows.mapInArrow(dense, f"doc_id {kind}, label int, fold int, row array<double>").toArrow().sort_by([("doc_id", "ascending")])
    x = np.array(got.column("row").to_pylist(), dtype=float).reshape(-1, len(NAMES))
    y = np.array(got.column("label").to_pylist(), dtype=float)
    fold = np.array(got.column("fold").to_pylist(), dtype=int)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        none = Trees(np.zeros((0, 7), np.int64), np.zeros((0, 7)), np.zeros((0, 8)), 0.0)
        return Model({}, none, (np.array([0.0]), np.array([share])))
    margins = np.zeros(len(y))
    for k in range(FOLDS):
        if (fold != k).any():
            margins[fold == k] = boost(x[fold != k], y[fold != k]).margin(x[fold == k])
    return Model(lexicons[-1], boost(x, y), isotonic(margins, y))


def score_toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, remainder: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.

    An empty or null text has a row of zeros for features and is scored by it. Repeated rows and null ids are scored like any other;
    a null id is not held out. An empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = key_and_text(docs).select("doc_id", held_out(F.col("doc_id"), remainder).alias("held_out"), "text")
    shape = rows.drop("text").schema.add("score", "double").add("predicted", "integer")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        make = Dense(fitted.lexicon)
        for batch in sized_batches(batches):
            x = np.array([make.of(t or "") for t in batch.column("text").to_pylist()]).reshape(-1, len(NAMES))
            found = fitted.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.float64()),
                 pa.array((found >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(score, shape)
