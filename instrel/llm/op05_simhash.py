"""SimHash near-duplicates found through a Golay code.

A 64-bit fingerprint is cut into three segments. The binary Golay code (23, 12,
7) is perfect: every 23-bit word lies within 3 bits of one codeword. A segment's
keys are the numbers of all codewords within 4 bits of it: one key if it is
within 2 bits of a codeword, else six. Two segments that differ in at most 2
bits always share a key. Two fingerprints at most 2 bits apart have, by the
pigeonhole principle, a segment without errors, and the next segment then has
at most 2: the exact bits of the one with the code keys of the other make the
join key, and a match is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from instrel.llm.common import key_and_text, sized_batches, stored, text_bytes
from instrel.llm.graph import components

#: Bits of the segments, from the lowest.
SEGMENTS = (22, 21, 21)
#: Members of a bucket that are still compared with each other.
SMALL = 16
#: Fixed value: generator polynomial of the cyclic Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
SEED = 42
#: Bits that linked fingerprints may differ in; what the keys guarantee.
MAX_BITS = 2
_CHUNK = 1 << 16


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator."""
    words = words.astype(np.int64)
    for bit in range(22, 10, -1):
        words = np.where(words >> bit & 1, words ^ (GENERATOR << (bit - 11)), words)
    return words


@cache
def error_patterns() -> np.ndarray:
    """For each syndrome the errors of at most 4 bits that have it: one, or six if the lightest has 3 bits; rows padded with the first."""
    table: list[list[int]] = [[] for _ in range(1 << 11)]
    patterns = [sum(1 << b for b in some) for n in range(5) for some in combinations(range(23), n)]
    for pattern, at in zip(patterns, syndrome(np.array(patterns)).tolist(), strict=True):
        table[at].append(pattern)
    return np.array([row + row[:1] * (6 - len(row)) for row in table], dtype=np.int64)


def code_keys(segment: np.ndarray) -> np.ndarray:
    """Numbers of the codewords near each word, six columns; a lone key is repeated."""
    return (segment.astype(np.int64)[:, None] ^ error_patterns()[syndrome(segment)]) >> 11


def _segments(fingerprints: np.ndarray) -> list[np.ndarray]:
    found, shift = [], 0
    for bits in SEGMENTS:
        found.append((fingerprints >> np.uint64(shift) & np.uint64((1 << bits) - 1)).astype(np.int64))
        shift += bits
    return found


def exact_keys(fingerprints: np.ndarray) -> np.ndarray:
    """18 join keys a row: fingerprints at most 2 bits apart share one. Repeats stand for segments with one code key."""
    parts = _segments(fingerprints)
    return np.concatenate(
        [(((i << 22) + parts[i])[:, None] << 12) + code_keys(parts[(i + 1) % 3]) for i in range(3)], axis=1)


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    counts = np.zeros(64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def shingle_fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of all shingles, repeats included; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    last = (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]) - 1
    hashes = np.fromiter(
        (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist(), strict=True)),
        dtype=np.uint64, count=n)
    return _majority(hashes)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of whole texts; ``fp`` is the fingerprint as a signed long, 0 for a text that is null or has no words."""
    rows = key_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches):
            found = np.array([shingle_fingerprint(t, shingle) for t in text_bytes(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(each, f"doc_id {kind}, fp bigint")


def keyed(nodes: DataFrame, keys) -> DataFrame:
    """A row for each distinct join key of each node: ``key`` and all columns of ``nodes``, which has ``node, fp``."""
    names = nodes.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, 1 << 18):
            found = np.sort(keys(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)), axis=1)
            first = np.ones(found.shape, dtype=bool)
            first[:, 1:] = found[:, 1:] != found[:, :-1]
            at = pa.array(np.nonzero(first)[0])
            yield pa.RecordBatch.from_arrays([pa.array(found[first]), *(batch.column(c).take(at) for c in names)], ["key", *names])

    return nodes.mapInArrow(each, "key bigint, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema))


def _apart(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(nodes: DataFrame, small: int = SMALL) -> DataFrame:
    """``u, v``: edges that connect the same nodes as all pairs at most ``MAX_BITS`` bits apart.

    ``nodes`` has one ``node`` for each distinct ``fp``. In a bucket of up to ``small`` nodes all pairs are verified. The nodes of
    larger buckets are tied without pairs: each names itself and the 64 fingerprints one bit away as centres;
    nodes at most 2 bits apart share a centre, and all that share one are at most 2 bits apart, so tying them to their smallest
    node is exact and its rows grow in proportion to the nodes.
    """
    rows = keyed(nodes.select("node", "fp"), exact_keys)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(rows.join(sizes, "key"), "shared")
    few = shared.where(F.col("n") <= small)
    a = few.select("key", F.col("node").alias("u"), F.col("fp").alias("fp_u"))
    b = few.select("key", F.col("node").alias("v"), F.col("fp").alias("fp_v"))
    pairs = a.join(b, "key").where((F.col("u") > F.col("v")) & (_apart("fp_u", "fp_v") <= MAX_BITS)).select("u", "v")
    one = F.lit(1).cast("bigint")
    centres = shared.where(F.col("n") > small).select("node", "fp").distinct().select("node", F.explode(F.array(
        F.col("fp"), *(F.col("fp").bitwiseXOR(F.shiftleft(one, bit)) for bit in range(64)))).alias("centre"))
    least = centres.groupBy("centre").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    stars = centres.join(least, "centre").where(F.col("node") > F.col("v")).select(F.col("node").alias("u"), "v")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id``: the smallest id that links of at most ``MAX_BITS`` bits reach.

    A null or wordless text has fingerprint zero and is linked like any other. A row with a null id gets the
    component of its fingerprint's other rows, else null. Repeated rows repeat. Rows of equal fingerprints are one node before any
    join, so copies cost nothing further.
    """
    found = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null")
    reached = components(links(nodes))
    labelled = nodes.join(reached, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return found.join(labelled, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """One row of ``docs`` for each group that links of at most ``MAX_BITS`` bits connect: that of the smallest id.

    Null ids come last; of rows with one id in a group the one of the smallest text hash stays, and of rows that repeat id and text one.
    Null and wordless texts have fingerprint zero and are one group. Groups are found on distinct fingerprints, so the number of
    copies of a text does not matter; texts move only in the join that picks the rows that stay.
    """
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash")).alias("key")
    found = stored(fingerprints(docs.select(key, "text"), shingle, "key"), "fingerprints")
    order = F.struct(F.col("doc_id.doc_id").isNull().alias("last"), F.col("doc_id").alias("key"))
    firsts = stored(found.groupBy(F.col("fp").alias("node")).agg(F.min(order).alias("first")), "nodes")
    reached = components(links(firsts.select("node", F.col("node").alias("fp"))))
    kept = firsts.join(reached, "node", "left").groupBy(F.coalesce("component", "node")).agg(F.min("first").alias("first")).select("first.key")
    rows = docs.select(F.struct(*docs.columns).alias("row"), key)
    return rows.join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
