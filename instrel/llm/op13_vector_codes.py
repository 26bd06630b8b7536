"""Product codes of vectors by exact k-means with norm-of-sum bounds.

Vectors become integers and are cut into equal parts, each with a codebook of
its own. A round assigns every part to its nearest entry and then moves the
entries to the means of what they hold. All codebooks since the first are kept.
For each part and each group of ``GROUP`` entries a row holds a lower bound on
the distance to the group's entries but its own, and the round it was measured
in. In a later round the bound less the group's true net displacement since that
round, that is the norm of the sum of its steps and not the sum of their norms,
still bounds the distance: a group above the distance to the row's own entry
cannot hold a nearer or equal one. Only the other groups are scanned again,
exactly, and their bounds measured anew.

Distances are integers and so exact; bounds are rounded down. A round is a job
over the rows that the one before has stored; only sums for each entry, a number that
does not depend on the table's size, reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instrel.llm.common import sized_batches, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Fixed value: components are counted in units of 1/256.
UNIT = 256
#: Entries of a codebook that share a bound.
GROUP = 8
#: Rows compared at once.
CHUNK = 4096
#: The largest bound that is stored; a smaller bound stays a bound.
_MOST = float(np.finfo(np.float16).max)


class Coded(NamedTuple):
    """``rows``: ``vec_id, label, code`` (a byte for each part), ``error, rescans``; ``codebooks``: parts x entries x components."""

    rows: DataFrame
    codebooks: np.ndarray


def _down(bounds: np.ndarray) -> np.ndarray:
    """Half-precision numbers that are not above the bounds."""
    capped = np.clip(bounds, 0, _MOST)
    half = capped.astype(np.float16)
    return np.where(half > capped, np.nextafter(half, np.float16(-np.inf)), half).astype(np.float16)


def net_moves(history: list[np.ndarray]) -> np.ndarray:
    """For each round and group the largest distance between an entry then and now."""
    now = history[-1]
    moved = [np.sqrt(((now - old) ** 2).sum(axis=1).astype(np.float64)) for old in history]
    return np.array([[m[g:g + GROUP].max() for g in range(0, len(now), GROUP)] for m in moved])


def assign(x: np.ndarray, history: list[np.ndarray], code: np.ndarray, low: np.ndarray, stamp: np.ndarray):
    """Nearest entries of the last codebook: new ``code, low, stamp``, the squared distances and how many groups each row scanned.

    ``low`` holds a row's bounds for each group as measured in round ``stamp``; a bound of 0 says nothing.
    """
    now, latest = history[-1], len(history) - 1
    every, groups = np.arange(len(x)), np.arange(low.shape[1])
    moved = net_moves(history)[stamp, groups[None, :]]
    own = ((x - now[code]) ** 2).sum(axis=1)
    reach = np.sqrt(own.astype(np.float64))[:, None]
    still = low.astype(np.float64) - moved
    slack = 1e-9 * (low + moved + reach + 1)  # far above what rounding of the square roots can amount to
    need = ~(still > reach + slack)
    best, least, scanned = code.copy(), own.copy(), {}
    for g in groups.tolist():
        rows = np.flatnonzero(need[:, g])
        if not len(rows):
            continue
        first = g * GROUP
        far = ((x[rows, None, :] - now[None, first:first + GROUP]) ** 2).sum(axis=2)
        at = far.argmin(axis=1)
        value = far[np.arange(len(rows)), at]
        at = at + first
        better = (value < least[rows]) | ((value == least[rows]) & (at < best[rows]))
        best[rows[better]], least[rows[better]] = at[better], value[better]
        scanned[g] = rows, far
    # An entry that was a row's own and is no more counts among its group's others.
    left = np.flatnonzero((best != code) & ~need[every, code // GROUP])
    bounds, stamp = low.astype(np.float64), stamp.copy()
    bounds[left, code[left] // GROUP] = np.minimum(still[left, code[left] // GROUP], reach[left, 0])
    stamp[left, code[left] // GROUP] = latest
    for g, (rows, far) in scanned.items():
        at = best[rows] - g * GROUP
        inside = np.flatnonzero((at >= 0) & (at < far.shape[1]))
        far[inside, at[inside]] = np.iinfo(np.int64).max
        bounds[rows, g] = np.sqrt(far.min(axis=1).astype(np.float64)) * (1 - 1e-12)
        stamp[rows, g] = latest
    return best, _down(bounds), stamp, least, need.sum(axis=1)


def _integers(batch: pa.RecordBatch, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("ints").to_pylist()), dtype=kind).reshape(batch.num_rows, width).astype(np.int64)


def _bytes_of(rows: np.ndarray) -> pa.Array:
    flat = np.ascontiguousarray(rows)
    step, data = flat.itemsize * flat.shape[1], flat.tobytes()
    return pa.array([data[i * step:(i + 1) * step] for i in range(len(flat))], pa.binary())


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, str, int]:
    """``vec_id, label, ints`` of the rows that take part, the integers' numpy type, and their number in a row."""
    rows = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector")).where(
        F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    extent = rows.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    longest, most = extent[0] or 0, int(UNIT * (extent[1] or 0.0)) + 1
    width = -(-longest // PARTS) * PARTS
    if width * (2 * most + 2) ** 2 >= 1 << 63:
        raise ValueError(f"squared distances of components up to {extent[1]} do not fit in 64 bits")
    kind = next(k for k, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if most < 1 << bits)
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches):
            lists = batch.column("vector")
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * UNIT).astype(kind)
            sizes = np.array([len(x) for x in lists], dtype=np.int64)
            wide = np.zeros((len(sizes), width), kind)
            wide[np.arange(width)[None, :] < sizes[:, None]] = values
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _bytes_of(wide)], ["vec_id", "label", "ints"])

    return rows.mapInArrow(each, f"vec_id {fields['vec_id']}, label {fields['label']}, ints binary"), kind, width


def _assigned(rows: DataFrame, history: list[np.ndarray], kind: str, width: int) -> DataFrame:
    """``rows`` with ``code, error, low, stamp`` by the last codebooks; ``rescans`` counts the groups scanned after the first round."""
    first, entries = len(history) == 1, history[0].shape[1]
    groups = -(-entries // GROUP)
    sent = rows.sparkSession.sparkContext.broadcast(history)
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}
    span = width // PARTS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, CHUNK) for at in range(0, whole.num_rows, CHUNK)):
                x, n = _integers(batch, kind, width), batch.num_rows
                if first:
                    code = np.zeros((n, PARTS), np.uint8)
                    low, stamp = np.zeros((n, PARTS, groups), np.float16), np.zeros((n, PARTS, groups), np.uint8)
                    rescans = np.zeros(n, np.int64)
                else:
                    read = lambda c, kind: np.frombuffer(b"".join(batch.column(c).to_pylist()), kind)  # noqa: B023, E731
                    code = read("code", np.uint8).reshape(n, PARTS).copy()
                    low, stamp = read("low", np.float16).reshape(n, PARTS, groups).copy(), read("stamp", np.uint8).reshape(n, PARTS, groups).copy()
                    rescans = batch.column("rescans").to_numpy()
                error = np.zeros(n, np.int64)
                for part in range(PARTS):
                    books = [h[part] for h in sent.value]
                    best, low[:, part], stamp[:, part], least, scans = assign(
                        x[:, part * span:(part + 1) * span], books, code[:, part].astype(np.int64), low[:, part], stamp[:, part].astype(np.int64))
                    code[:, part] = best
                    error += least
                    rescans = rescans + (0 if first else scans)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), batch.column("ints"), _bytes_of(code), pa.array(error),
                     _bytes_of(low.reshape(n, -1)), _bytes_of(stamp.reshape(n, -1)), pa.array(rescans)],
                    ["vec_id", "label", "ints", "code", "error", "low", "stamp", "rescans"])

    return rows.mapInArrow(
        each, f"vec_id {fields['vec_id']}, label {fields['label']}, ints binary, code binary, error bigint, low binary, stamp binary, rescans bigint")


def _moved(state: DataFrame, books: np.ndarray, kind: str, width: int) -> np.ndarray:
    """The codebooks with each used entry at the floor of the mean of its parts; sums are added up in each task and exact."""
    entries, span = books.shape[1], width // PARTS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((PARTS, entries, span), np.int64), np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            x = _integers(batch, kind, width)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, PARTS)
            for part in range(PARTS):
                np.add.at(sums[part], code[:, part], x[:, part * span:(part + 1) * span])
                counts[part] += np.bincount(code[:, part], minlength=entries)
        part, entry = np.nonzero(counts)
        # The count stands before the components, as one more number of the entry.
        values = np.concatenate([counts[part, entry][:, None], sums[part, entry]], axis=1)
        at = np.tile(np.arange(span + 1, dtype=np.int32), len(part))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, span + 1).astype(np.int32)), pa.array(np.repeat(entry, span + 1).astype(np.int32)), pa.array(at),
             pa.array(values.reshape(-1))], ["part", "entry", "at", "value"])

    partial = state.select("ints", "code").mapInArrow(each, "part int, entry int, at int, value bigint")
    totals = partial.groupBy("part", "entry", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()  # entries x (width + parts) rows
    exact = {(r.part, r.entry, r["at"]): int(r.value) for r in totals}
    moved = books.copy()
    for (part, entry, at), value in exact.items():
        if at:
            moved[part, entry, at - 1] = value // exact[part, entry, 0]
    return moved


def compress(
    vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> Coded:
    """Codes of all vectors and the codebooks that ``rounds`` rounds give.

    Rows whose vector is null or holds null, NaN or infinite components are left out; repeated rows all count. Vectors shorter than the
    longest, or than a multiple of ``PARTS``, are read as if zeros followed. The first codebook is made of the rows of the smallest ids, null
    ids last and rows of one id by their integers; with fewer rows than ``entries`` it has as many entries as rows. No rows give no codes and
    empty codebooks. Components whose squared distances exceed 64 bits raise ``ValueError``.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has 1 to 256 entries")
    rows, kind, width = prepared(vectors, id_col, vector_col, label_col)
    state = stored(rows, "integers")
    span = width // PARTS
    smallest = state.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).collect()
    books = np.frombuffer(b"".join(bytes(r.ints) for r in smallest), kind).astype(np.int64).reshape(len(smallest), PARTS, span).transpose(1, 0, 2)
    if not smallest:
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("code", "binary"), ("error", "bigint"), ("rescans", "bigint"))]
        return Coded(state.select("vec_id", "label", *nothing), books)
    history = [np.ascontiguousarray(books)]
    for _ in range(rounds):
        state = stored(_assigned(state, history, kind, width), "codes")
        history.append(_moved(state, history[-1], kind, width))
    final = stored(_assigned(state, history, kind, width).select("vec_id", "label", "code", "error", "rescans"), "codes")
    return Coded(final, history[-1])


def spelled(codebooks: np.ndarray) -> str:
    """All integers by part, entry and position, with commas between."""
    return ",".join(map(str, codebooks.reshape(-1).tolist()))
