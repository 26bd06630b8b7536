"""Quality classifier: naive Bayes features under a linear support vector machine.

A document's features are indicators: which hashed n-grams it holds (words and
word pairs, byte triples, and runs of six character classes, which show shouting,
tables and symbol noise), and how much it repeats itself. Every indicator is
scaled by its class log-count ratio, and a hinge-loss linear model is fitted on
the scaled indicators by dual coordinate descent. A logistic curve fitted on
margins of folds left out maps margins to 0..1.

The model is fitted on the driver from a bounded sample of labelled rows; scoring
reads whole texts in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh32_intdigest

from instrel.llm.common import held_out, key_and_text, sized_batches, text_bytes

#: Hashed features; bounds the model that is broadcast (8 bytes each).
DIMENSIONS = 1 << 16
#: Labelled rows fitted on, about; bounds what the driver gathers.
SAMPLE = 4000
#: Distinct words remembered by a task.
REMEMBERED = 200_000

# Fixed classes of characters: letters by case, digits, blanks, line ends, other
# bytes of UTF-8 as small letters; each ASCII sign is its own class.
_CLASSES = np.zeros(256, dtype=np.uint32)
_CLASSES[ord("A"):ord("Z") + 1] = 1
_CLASSES[ord("a"):ord("z") + 1] = 2
_CLASSES[128:] = 2
_CLASSES[ord("0"):ord("9") + 1] = 3
_CLASSES[[32, 9]] = 4
_CLASSES[[10, 13]] = 5
for _i, _sign in enumerate("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _CLASSES[ord(_sign)] = 6 + _i
_MULTIPLIER = np.uint32(0x9E3779B1)


def _hashed(values: np.ndarray, kind: int, bits: int) -> np.ndarray:
    """``values`` of one kind spread over the features."""
    mixed = (values.astype(np.uint32) ^ np.uint32(kind * 0x85EBCA6B & 0xFFFFFFFF)) * _MULTIPLIER
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return mixed >> np.uint32(32 - bits)


class _Hashes(dict):
    """Hashes of words, made when first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxh32_intdigest(word)
        return value


class Features:
    """Indicators of texts: ``of(text)`` gives the sorted distinct feature numbers."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.bits = dimensions.bit_length() - 1
        self.known = _Hashes()
        self.marks = np.zeros(dimensions, dtype=bool)

    def of(self, text: bytes) -> np.ndarray:
        marks = self.marks
        raw = np.frombuffer(text, dtype=np.uint8).astype(np.uint32)
        if len(raw) >= 3:
            marks[_hashed((raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:], 1, self.bits)] = True
        if len(raw) >= 6:
            c = _CLASSES[raw]
            run = c[:-5].copy()
            for k in range(1, 6):
                run *= np.uint32(39)
                run += c[k:len(c) - 5 + k]
            marks[_hashed(run, 2, self.bits)] = True
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = text.lower().split()
        if split:
            words = np.array(list(map(self.known.__getitem__, split)), dtype=np.uint32)
            marks[_hashed(words, 3, self.bits)] = True
            marks[_hashed(words[:-1] * np.uint32(31) + words[1:], 4, self.bits)] = True
            same, distinct = np.count_nonzero(words[1:] == words[:-1]), len(set(split))
            # Eighths of words equal to the one before, and tenths of words that are distinct.
            marks[_hashed(np.array([8 * same // len(words), 100 + 10 * distinct // len(words)]), 5, self.bits)] = True
        found = np.flatnonzero(marks)
        marks[found] = False
        return found


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    dimensions: int

    def score(self, features: np.ndarray) -> float:
        margin = float(self.weights[features].sum()) / max(1, len(features)) ** 0.5 + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def _ratios(rows: list[np.ndarray], labels: np.ndarray, dimensions: int, smoothing: float) -> np.ndarray:
    """Log ratio of each indicator's share of all indicators in class 1 to that in class 0."""
    shares = []
    for label in (1, 0):
        counts = np.full(dimensions, smoothing)
        for features in (f for f, y in zip(rows, labels, strict=True) if y == label):
            counts[features] += 1
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def _descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, cost: float, epochs: int, seed: int):
    """Dual coordinate descent for hinge loss; rows have length 1 but for their scaling. The bias is a constant feature.

    Rows of the rarer class cost more, so that both classes weigh alike.
    """
    y = np.where(labels == 1, 1.0, -1.0)
    share = labels.mean()
    bound = cost * np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    norms = np.array([max(1, len(f)) ** -0.5 for f in rows])
    squares = np.array([(scale[f] ** 2).sum() * n * n + 1.0 for f, n in zip(rows, norms, strict=True)])
    weights, bias, alpha = np.zeros(len(scale)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            f, n = rows[i], norms[i]
            gradient = y[i] * ((weights[f] * scale[f]).sum() * n + bias) - 1
            new = min(max(alpha[i] - gradient / squares[i], 0.0), bound[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                weights[f] += step * n * scale[f]
                bias += step
                moved = max(moved, abs(step))
        if moved < 1e-3 * cost:
            break
    return weights * scale, bias


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through smoothed labels, by Newton's method."""
    high, low = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (high + 1) / (high + 2), 1 / (low + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -500, 500)))
        w, g = np.maximum(p * (1 - p), 1e-9), p - target
        h = np.array([[(w * margins**2).sum() + 1e-6, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, [(g * margins).sum(), g.sum()])
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return max(a, 1e-3), b


def fit_rows(
    rows: list[np.ndarray], labels: np.ndarray, dimensions: int = DIMENSIONS, cost: float = 1.0, smoothing: float = 1.0,
    epochs: int = 15, folds: int = 3, seed: int = 7,
) -> Model:
    """A model of feature lists and their 0/1 labels. With one class only, the score is that class's smoothed share."""
    if len(rows) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(rows) + 2) if len(rows) else 0.5
        return Model(np.zeros(dimensions), 0.0, 1.0, float(np.log(share / (1 - share))), dimensions)

    def linear(some: np.ndarray):
        part, y = [rows[i] for i in some], labels[some]
        return _descend(part, y, _ratios(part, y, dimensions, smoothing), cost, epochs, seed)

    fold = np.random.default_rng(seed).permutation(len(rows)) % folds
    margins, measured = np.zeros(len(rows)), np.zeros(len(rows), bool)
    for k in range(folds):
        some = np.flatnonzero(fold != k)
        if labels[some].min() == labels[some].max():
            continue
        w, b = linear(some)
        for i in np.flatnonzero(fold == k):
            margins[i] = w[rows[i]].sum() * max(1, len(rows[i])) ** -0.5 + b
            measured[i] = True
    w, b = linear(np.arange(len(rows)))
    slope, shift = _curve(margins[measured], labels[measured]) if measured.any() else (1.0, 0.0)
    return Model(w, float(b), float(slope), float(shift), dimensions)


def labelled_sample(labels: DataFrame, label_col: str, remainder: int, sample: int) -> DataFrame:
    """``doc_id, label`` of about ``sample`` training rows at most, chosen by a hash of the id."""
    rows = labels.select(F.col("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), remainder)
    ).groupBy("doc_id").agg(F.max("label").alias("label"))
    total = rows.count()
    share = min(1.0, sample / max(total, 1))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))


def labelled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``doc_id, label, text``: one row for each chosen id, so no more than were chosen. Of several texts of an id the one of the smallest hash counts."""
    # The chosen ids are bounded by the sample.
    return key_and_text(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def fit_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", remainder: int = 0,
    dimensions: int = DIMENSIONS, sample: int = SAMPLE,
) -> Model:
    """A model of the labelled rows that are not held out. ``sample`` bounds them; a document of several rows counts once."""
    chosen = labelled_sample(labels, label_col, remainder, sample)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Features(dimensions)
        for batch in batches:
            rows = [make.of(t).astype("<u4").tobytes() for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(rows, pa.binary())], ["doc_id", "label", "features"])

    joined = labelled_texts(docs, chosen)
    kind = joined.schema["doc_id"].dataType.simpleString()
    gathered = joined.select("doc_id", "label", "text").mapInArrow(
        features, f"doc_id {kind}, label int, features binary").toArrow().sort_by([("doc_id", "ascending")])
    rows = [np.frombuffer(x, dtype="<u4") for x in gathered.column("features").to_pylist()]
    return fit_rows(rows, np.array(gathered.column("label").to_pylist(), dtype=int), dimensions)


def score_quality(docs: DataFrame, model: Model, threshold: float = 0.3, remainder: int = 0, whole_rows: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; with ``whole_rows`` also the row itself as a struct ``row``.

    An empty or null text has no indicators and gets the score of the bias alone. Repeated rows and null ids are
    scored like any other; a null id is not held out. An empty table gives none.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col("doc_id"), held_out(F.col("doc_id"), remainder).alias("held_out"), F.col("text"),
        *([F.struct(*docs.columns).alias("row")] if whole_rows else []))
    shape = rows.drop("text").schema.add("score", "double").add("predicted", "integer")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = sent.value
        make = Features(fitted.dimensions)
        for batch in sized_batches(batches):
            scores = [fitted.score(make.of(t)) for t in text_bytes(batch.column("text"))]
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(scores, pa.float64()),
                 pa.array([int(s >= threshold) for s in scores], pa.int32())], [*kept, "score", "predicted"])

    return rows.mapInArrow(score, shape)
