"""Nearest neighbours by cross-polytope hashing.

Largest inner products become nearest unit vectors: every vector is divided by
the largest norm and gets one more component that completes it to length 1; a
query is divided by its own norm and gets 0 there. Unit vectors, padded to a
power of two, are turned by a pseudo-rotation (three rounds of random signs and
a fast Hadamard transform) and assigned to the nearest signed axis. A table joins
one or more such functions, so that a bucket holds about ``FILL`` vectors whatever the
number of vectors; the last function may look at the first coordinates only.
A query looks into the buckets of its best axes in every table (multiprobe) and
candidates are ranked exactly on the original vectors.

Equal vectors are one query, and as candidates only as many of them as an answer can hold take part.
Buckets of more than ``CHUNK`` rows or queries are dealt to several tasks. Queries
that find too few candidates are compared with all vectors, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from instrel.llm.common import sized_batches, stored

TABLES = 16
#: Buckets a query looks into in each table of 2 x dimension buckets; tables of more buckets take more, by the power ``GROWTH``.
PROBES, GROWTH = 12, 0.65
FILL = 200
CHUNK = 4096


class Hashing(NamedTuple):
    """``axes``: coordinates that each function of a table looks at."""

    width: int
    padded: int
    norm: float
    axes: tuple[int, ...]
    probes: int
    tables: int
    seed: int


def hashing(count: int, width: int, norm: float, tables: int = TABLES, probes: int = PROBES, seed: int = 11) -> Hashing:
    """Functions for so many vectors of ``width`` components and ``norm`` at most."""
    padded = 1 << max(1, width).bit_length()
    axes, buckets = [padded], 2 * padded
    while buckets * FILL < count and len(axes) < 3:
        axes.append(min(padded, 1 << max(0, ceil(np.log2(count / (FILL * buckets))) - 1)))
        buckets *= 2 * axes[-1]
    return Hashing(width, padded, norm, tuple(axes), ceil(probes * (buckets / (2 * padded)) ** GROWTH), tables, seed)


def _rotate(rows: np.ndarray, seed: tuple[int, ...]) -> np.ndarray:
    """Three rounds of signs and Hadamard transform."""
    signs, n = np.random.default_rng(seed), rows.shape[1]
    for _ in range(3):
        rows = rows * signs.choice([-1.0, 1.0], n)
        half = 1
        while half < n:
            pairs = rows.reshape(len(rows), -1, 2, half)
            rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), n)
            half *= 2
        rows = rows / np.sqrt(n)
    return rows


def _unit(vectors: np.ndarray, how: Hashing, query: bool) -> np.ndarray:
    out = np.zeros((len(vectors), how.padded))
    squares = (vectors**2).sum(axis=1)
    if query:
        out[:, :how.width] = vectors / np.sqrt(squares)[:, None]
    else:
        out[:, :how.width] = vectors / how.norm
        out[:, how.width] = np.sqrt(np.maximum(0.0, 1 - squares / how.norm**2))
    return out


def _signed(rows: np.ndarray, axes: int) -> np.ndarray:
    """Closeness to each signed axis: even columns the positive, odd the negative."""
    part = rows[:, :axes]
    return np.stack([part, -part], axis=2).reshape(len(rows), -1)


def buckets(vectors: np.ndarray, how: Hashing, query: bool) -> np.ndarray:
    """Bucket numbers, a column for each table, or for each table and probe from the best on."""
    units, columns = _unit(vectors, how, query), []
    every = np.arange(len(vectors))[:, None]
    for table in range(how.tables):
        code = np.zeros((len(vectors), 1), dtype=np.int64)
        close = np.zeros((len(vectors), 1))
        for number, axes in enumerate(how.axes):
            near = _signed(_rotate(units, (how.seed, table, number)), axes)
            most = min(how.probes if query else 1, near.shape[1])
            best = np.argsort(-near, axis=1, kind="stable")[:, :most]
            close = (close[:, :, None] + near[every, best][:, None, :]).reshape(len(vectors), -1)
            code = (code[:, :, None] * (2 * axes) + best[:, None, :]).reshape(len(vectors), -1)
            order = np.argsort(-close, axis=1, kind="stable")[:, :how.probes if query else 1]
            code, close = code[every, order], close[every, order]
        columns.append(code * how.tables + table)
    return np.concatenate(columns, axis=1)


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a binary column of float64 values."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(-1, width)


def best_pairs(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query positions, ids and scores of each query's ``k`` rows of largest inner product, ties to smaller ids."""
    found = []
    for start in range(0, len(queries), 256):
        part = queries[start:start + 256]
        near = part @ rows.T
        if len(rows) > k:
            least = np.partition(near, len(rows) - k, axis=1)[:, len(rows) - k]
            q, r = np.nonzero(near >= (least - 1e-9 * np.maximum(1.0, np.abs(least)))[:, None])
        else:
            q, r = np.nonzero(np.ones(near.shape, bool))
        exact = (part[q] * rows[r]).sum(axis=1)
        order = np.lexsort((ids[r], -exact, q))
        q, r, exact = q[order], r[order], exact[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        found.append((q[place < k] + start, ids[r[place < k]], exact[place < k]))
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(3))


def _meet(queries: DataFrame, rows: DataFrame, keys: list[str], width: int, k: int) -> DataFrame:
    """``rep, vec_id, score``: each query's best rows of its groups, once a group."""
    def pairs(asked: pa.Table, there: pa.Table) -> pa.Table:
        if asked.num_rows and there.num_rows:
            reps, ids = asked.column("rep").to_numpy(), there.column("vec_id").to_numpy()
            q, found, scores = best_pairs(_matrix(asked.column("vector"), width), _matrix(there.column("vector"), width), ids, k)
            reps = reps[q.astype(np.int64)]
        else:
            reps, found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table([pa.array(reps), pa.array(found.astype(np.int64)), pa.array(scores)], names=["rep", "vec_id", "score"])

    return queries.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(pairs, "rep bigint, vec_id bigint, score double")


def _hashed(frame: DataFrame, how: Hashing, query: bool) -> DataFrame:
    """A row for each bucket of each vector."""
    own = "rep" if query else "vec_id"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, 1 << 17):
            found = buckets(_matrix(batch.column("vector"), how.width), how, query)
            at = pa.array(np.repeat(np.arange(batch.num_rows), found.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ravel()), batch.column(own).take(at), batch.column("vector").take(at)], ["bucket", own, "vector"])

    return frame.select(own, "vector").mapInArrow(each, f"bucket bigint, {own} bigint, vector binary")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_search(queries: DataFrame, rows: DataFrame, width: int, k: int, blocks: int) -> DataFrame:
    """``queries(rep, vector)`` against all ``rows(vec_id, vector)``: blocks of rows with chunks of about ``CHUNK`` queries, each a task's group."""
    queries = stored(queries.select("rep", "vector"), "asked")
    chunks = max(1, ceil(queries.count() / CHUNK))
    number = lambda of, n: F.pmod(F.xxhash64(of), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("chunk", number("rep", chunks)).withColumn("block", every(blocks))
    dealt = rows.withColumn("block", number("vec_id", blocks)).withColumn("chunk", every(chunks))
    return _best(_meet(asked, dealt, ["block", "chunk"], width, k), k)


def _tables(vectors: DataFrame, k: int, every: int, id_col: str, vector_col: str):
    """Valid rows as ``vec_id, vector``; their number, width and largest norm; candidates; distinct queries with all their ids."""
    raw = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("parts")).where(
        F.col("vec_id").isNotNull() & F.col("parts").isNotNull() & (F.size("parts") > 0)
        & F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("parts", lambda x: x != 0))
    sizes = raw.groupBy(F.size("parts").alias("width")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.sqrt(F.aggregate("parts", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"))
    first = sizes.orderBy(F.desc("rows"), "width").first()
    width = first.width if first else 1
    rows = raw.where(F.size("parts") == width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("parts").flatten().to_numpy() + 0.0  # -0.0 and 0.0 are equal
            packed = [v.tobytes() for v in values.reshape(-1, width)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "vector"])

    packed = stored(rows.mapInArrow(pack, "vec_id bigint, vector binary").distinct(), "vectors")
    # The query itself and k others of the same vector are all that an answer can need.
    alike = Window.partitionBy("vector").orderBy("vec_id")
    candidates = stored(packed.withColumn("nr", F.row_number().over(alike)).where(F.col("nr") <= k + 1).drop("nr"), "candidates")
    asked = packed.where(F.col("vec_id") % every == 0)
    reps = asked.groupBy("vector").agg(F.min("vec_id").alias("rep"))
    return packed, (first.rows if first else 0), width, (first.norm if first else 1.0), candidates, asked, reps


def _answers(asked: DataFrame, reps: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Each query's own ``k`` of its representative's ``k`` + 1, without itself."""
    lists = found.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("found"))  # k + 1 at most
    queries = asked.join(reps, "vector").select(F.col("vec_id").alias("query_id"), "rep").join(lists, "rep")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return queries.select("query_id", F.posexplode(others).alias("place", "hit")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id is divisible by ``every``, itself left out.

    Nearness is the inner product in double precision; ties go to the smaller id. Vectors that are null, zero or hold a
    null or non-finite component take no part, nor do null ids and vectors not of the most frequent length. Rows that repeat
    an id and a vector count once. With no more than ``k`` candidates all are returned. An empty table gives none.
    """
    _, count, width, norm, candidates, asked, reps = _tables(vectors, k, every, id_col, vector_col)
    how = hashing(count, width, norm, tables, probes)
    queries, rows = _hashed(reps, how, True), _hashed(candidates, how, False)
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).join(
        queries.groupBy("bucket").agg(F.count(F.lit(1)).alias("asking")), "bucket").select(
        "bucket", F.ceil(F.col("held") / CHUNK).cast("int").alias("row_chunks"), F.ceil(F.col("asking") / CHUNK).cast("int").alias("query_chunks"))
    sizes = stored(sizes, "sizes")
    every_chunk = lambda chunks: F.explode(F.sequence(F.lit(0), F.col(chunks) - 1))
    rows = rows.join(sizes, "bucket").select(
        "bucket", "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.col("row_chunks")).cast("int").alias("row_chunk"), every_chunk("query_chunks").alias("query_chunk"))
    queries = queries.join(sizes, "bucket").select(
        "bucket", "rep", "vector", F.pmod(F.xxhash64("rep"), F.col("query_chunks")).cast("int").alias("query_chunk"), every_chunk("row_chunks").alias("row_chunk"))
    found = stored(_best(_meet(queries, rows, ["bucket", "row_chunk", "query_chunk"], width, k + 1), k + 1), "found")
    short = reps.join(found.where(F.col("rank") > k).select("rep"), "rep", "left_anti")
    rest = exact_search(short, candidates, width, k + 1, max(1, ceil(count / (8 * CHUNK))))
    whole = found.join(found.where(F.col("rank") > k).select("rep"), "rep", "left_semi").select("rep", "vec_id", "score", "rank").unionByName(rest)
    return _answers(asked, reps, whole, k)


def recall(vectors: DataFrame, found: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Share of the true ``k`` nearest of all queries that ``found`` holds, by comparison with all rows in blocks."""
    _, count, width, _, candidates, asked, reps = _tables(vectors, k, every, id_col, vector_col)
    true = _answers(asked, reps, exact_search(reps, candidates, width, k + 1, max(1, ceil(count / (8 * CHUNK)))), k)
    hits = true.select("query_id", "vec_id").join(found.select("query_id", "vec_id"), ["query_id", "vec_id"]).count()
    return hits / max(1, true.count())
