"""Benchmark decontamination by winnowing.

Of every ``WINDOW`` words in a row the fingerprint of one ``GRAM``-word gram is
kept: the smallest hash among the grams of the window, the last one on ties. Any
span of ``WINDOW`` words that a document shares with a benchmark item thus has a
kept gram in common with it. Fingerprints of both sides are joined, and every
match is extended to both sides word by word. Items shorter than a window are
found by fingerprints of grams as long as the item, none of which is left out.

Documents ask a bitmap of the benchmark's fingerprints before the join; it has a
fixed size whatever the benchmark's, so a larger one only lets more rows pass on
to the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from instrel.llm.common import sized_batches, stored, text_bytes

WINDOW = 10
GRAM = 5
#: Bits of the bitmap's index: 2 MiB are sent to the executors.
SLOT_BITS = 24
#: Words whose hashes a task remembers.
REMEMBERED = 200_000

# A-Z in lower case; all ASCII but digits and letters parts words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxh64_intdigest(word)
        return value


def _gram_hashes(words: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each run of ``gram`` words."""
    if len(words) < gram:
        return np.zeros(0, np.uint64)
    n = len(words) - gram + 1
    mixed = np.full(n, gram, dtype=np.uint64)
    for k in range(gram):
        mixed = (mixed ^ words[k:k + n]) * _ODD
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _kept(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the last smallest hash of every ``span`` hashes in a row."""
    n = len(hashes) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = hashes[:n].copy()
    at = np.arange(n)
    for k in range(1, span):
        other = hashes[k:k + n]
        better = other <= least
        least[better] = other[better]
        at[better] = np.flatnonzero(better) + k
    at.sort()
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def _grams(hashes: np.ndarray, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For windows of 10 words and for each short length: the length, the kept positions and their hashes."""
    full = _gram_hashes(hashes, GRAM)
    at = _kept(full, WINDOW - GRAM + 1)
    yield WINDOW, at, full[at]
    for length in lengths:
        short = _gram_hashes(hashes, length) ^ np.uint64(length)
        yield length, np.arange(len(short)), short


def _rows(id_col: str, text_col: str, fields: str, only_items: bool, lengths: list[int], slots):
    """A mapInArrow function: a row for each fingerprint that ``slots`` (a bitmap, None for all) may hold.

    Columns: the id, hash, length, position, and the words around: up to ``WINDOW - GRAM`` on each side of a gram of a full window.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        bitmap = None if slots is None else slots.value
        for batch in sized_batches(batches):
            found: list[tuple] = []
            ids: list[int] = []
            for row, text in enumerate(text_bytes(batch.column(text_col))):
                words = words_of(text)
                if len(known) > REMEMBERED:
                    known.clear()
                hashes = np.array(list(map(known.__getitem__, words)), dtype=np.uint64)
                own = [len(words)] if only_items and 0 < len(words) < WINDOW else [] if only_items else lengths
                for length, at, marks in _grams(hashes, own):
                    if bitmap is not None and len(marks):
                        slot = (marks >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                        hit = bitmap[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 > 0
                        at, marks = at[hit], marks[hit]
                    gram = GRAM if length == WINDOW else length
                    for p, mark in zip(at.tolist(), marks.view(np.int64).tolist(), strict=True):
                        low = max(0, p - WINDOW + gram)
                        found.append((mark, length, p, low, b" ".join(words[low:p + WINDOW]) if length == WINDOW
                                      else b" ".join(words[p:p + length])))
                        ids.append(row)
            marks, spans, places, lows, around = zip(*found, strict=True) if found else ([], [], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(ids, pa.int64())), pa.array(marks, pa.int64()), pa.array(spans, pa.int32()),
                 pa.array(places, pa.int32()), pa.array(lows, pa.int32()), pa.array(around, pa.binary()).cast(pa.string())],
                [id_col, "mark", "length", "at", "low", "around"])

    return each, f"{fields}, mark bigint, length int, at int, low int, around string"


def _bitmap(fingerprints: DataFrame) -> np.ndarray:
    """Which slots the fingerprints' upper bits hold; at most 2^18 rows of 64 slots reach the driver."""
    slot = F.shiftrightunsigned("mark", 64 - SLOT_BITS)
    words = fingerprints.groupBy(F.shiftright(slot, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(mark, {64 - SLOT_BITS}) & 63 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(1 << (SLOT_BITS - 6), dtype=np.uint64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bitmap.view(np.uint8)


def _extend(joined: DataFrame) -> DataFrame:
    """The word range of the document around each match that lies in windows of the item, if any."""
    keys = joined.schema["doc"].dataType.simpleString(), joined.schema["item_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches):
            starts, ends = [], []
            columns = [batch.column(c).to_pylist() for c in ("length", "at", "low", "around", "item_at", "item_around")]
            for length, at, low, around, item_at, item_around in zip(*columns, strict=True):
                x, y = around.split(" "), item_around.split(" ")
                if length < WINDOW:
                    a, b = (at, at + length) if x == y else (0, 0)
                else:
                    i, j = at - low, item_at
                    same = x[i:i + GRAM] == y[j:j + GRAM]
                    left = right = 0
                    while same and left < min(i, j) and x[i - left - 1] == y[j - left - 1]:
                        left += 1
                    while same and i + GRAM + right < len(x) and j + GRAM + right < len(y) and x[i + GRAM + right] == y[j + GRAM + right]:
                        right += 1
                    a, b = (at - left, at + GRAM + right) if same and left + GRAM + right >= WINDOW else (0, 0)
                starts.append(a)
                ends.append(b)
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("item_id"), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["doc", "item_id", "start", "end"])
            yield out.filter(pa.array([b > 0 for b in ends], pa.bool_()))

    return joined.mapInArrow(each, f"doc {keys[0]}, item_id {keys[1]}, start int, end int")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows as ``doc, text``; equal ids with different texts are different documents."""
    return docs.select(
        F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash")).alias("doc"), F.col(text_col).alias("text"))


def shared_spans(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc, item_id, start, end``: word ranges of documents that are made of windows of an item; ``doc`` holds ``doc_id``.

    Every word of every occurrence of a window is in one of the ranges, which may overlap. Null and wordless texts share nothing,
    nor do null items; repeated rows give repeated ranges, and an item that repeats itself gives as many as it has different contexts. A fingerprint that a third of all documents hold is only the larger
    side of an equi-join, which adaptive execution splits.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).where("text is not null and item_id is not null")
    kind = items.schema["item_id"].dataType.simpleString()
    grams = stored(items.mapInArrow(*_rows("item_id", "text", f"item_id {kind}", True, [], None)).distinct(), "item-grams")
    lengths = sorted(r.length for r in grams.select("length").distinct().collect() if r.length < WINDOW)  # at most 9
    slots = spark.sparkContext.broadcast(_bitmap(grams))
    rows = _keyed(docs, id_col, text_col).where("text is not null")
    kind = rows.schema["doc"].dataType.simpleString()
    marks = rows.mapInArrow(*_rows("doc", "text", f"doc {kind}", False, lengths, slots))
    # Where a gram stands in its context is all that extending needs, so an item that repeats itself gives one row for each context.
    contexts = grams.select(
        "item_id", "mark", "length", (F.col("at") - F.col("low")).alias("item_at"), F.col("around").alias("item_around")).distinct()
    return _extend(marks.join(contexts, ["mark", "length"]))


def _word_counts(rows: DataFrame) -> DataFrame:
    kind = rows.schema["doc"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches):
            counts = [len(words_of(t)) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(counts, pa.int64())], ["doc", "n_words"])

    return rows.mapInArrow(each, f"doc {kind}, n_words bigint")


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_hit, items, contaminated`` of every row.

    ``n_hit`` counts the words inside windows of any item and ``items`` lists the items, sorted as strings. A null or
    wordless text has no words and no hits; without a benchmark nothing is hit. Repeated rows repeat.
    """
    found = shared_spans(docs, benchmark, id_col, text_col, item_col, item_text).groupBy("doc").agg(
        F.collect_set(F.struct("start", "end")).alias("ranges"), F.collect_set(F.col("item_id").cast("string")).alias("items"))
    union = F.aggregate(
        F.array_sort("ranges"), F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).alias("reach")),
        lambda so_far, r: F.struct(
            (so_far["total"] + F.greatest(F.lit(0), r["end"] - F.greatest(r["start"], so_far["reach"]))).alias("total"),
            F.greatest(so_far["reach"], r["end"]).alias("reach")), lambda so_far: so_far["total"])
    hits = found.select("doc", union.alias("hit"), F.array_sort("items").alias("items"))
    counts = _word_counts(_keyed(docs, id_col, text_col))
    return counts.join(hits, "doc", "left").select(
        "doc.doc_id", "n_words", F.coalesce("hit", F.lit(0).cast("bigint")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("hit").isNotNull().alias("contaminated"))


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark; null texts are clean."""
    bad = shared_spans(docs, benchmark).select("doc").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("doc"))
    return rows.join(bad, "doc", "left_anti").select("row.*")
