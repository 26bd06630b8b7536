"""Byte-level BPE over distinct words.

Texts are cut into blocks of a few megabytes. A first pass sends every word
(match of the pre-token pattern) of a block once, with the block and the word's
number in it, to the partition of the word, where all blocks' copies of it meet
and it is encoded once. The ids go back to the blocks. A second pass sends each
document's word numbers, in order and compressed, to its block, where numbers
become ids. So a word crosses the network once a block, not once an occurrence,
and a word that is in every text costs one row a block.

Decoding looks ids up in the table of token bytes, whose size the rank file
bounds; it is broadcast.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64

from instrel.llm.common import sized_batches

#: Bytes of text in a block, at most by about a batch: memory of a task against rows sent.
BLOCK = 32 << 20
#: Words whose ids a task packs together on their way back.
PACKED = 500_000
#: Pieces of text whose words a task puts in a row at once.
PARTS = 1 << 18


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a file in tiktoken's format."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def encode_word(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one word: of all neighbours whose join is a token, the join of lowest rank, leftmost on ties, is made first."""
    if word in rank:
        return [rank[word]]
    n = len(word)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    start = list(range(n + 1))
    end = list(range(1, n + 1))  # of the part that starts here; 0: joined to the part before
    heap = []
    for i in range(n - 1):
        found = rank.get(word[i:i + 2])
        if found is not None:
            heap.append((found, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if end[i] else n
        if not end[i] or j >= n or end[j] != stop:
            continue  # one of the two has changed since
        end[i], end[j] = stop, 0
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            found = rank.get(word[start[i]:end[k]])
            if found is not None:
                heapq.heappush(heap, (found, i, end[k]))
        h = before[i]
        if h >= 0:
            found = rank.get(word[h:stop])
            if found is not None:
                heapq.heappush(heap, (found, h, stop))
    ids, i = [], 0
    while i < n:
        ids.append(rank[word[i:end[i]]])
        i = after[i]
    return ids


class _Numbers(dict):
    """Numbers of words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


# A blank between two characters that are no white space; the library's white space includes the pattern's.
_ALONE = re.compile(r"(?<=\S) (?=\S)")
_OTHER = re.compile(r"[^\S \n]")


def pieces_of(text: str) -> list[str]:
    """The text cut at each blank that stands between two characters that are no white space."""
    plain = not ("  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " " or _OTHER.search(text))
    return text.split(" ") if plain else _ALONE.split(text)


def ragged(numbers: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` with these numbers, one after the other; run k has ``lengths[k]`` values."""
    starts = np.cumsum(lengths) - lengths
    each = lengths[numbers]
    ends = np.cumsum(each)
    shift = (starts[numbers] - (ends - each)).astype(np.int32)
    places = np.repeat(shift, each)
    places += np.arange(len(places), dtype=np.int32)
    return flat[places]


class Block(NamedTuple):
    """Texts of one task that share a dictionary."""

    name: int
    ids: list[pa.Array]
    words: pa.Array
    sizes: np.ndarray
    numbers: np.ndarray


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, parted: bool) -> Iterator[Block]:
    """Blocks of rows ``doc_id, text`` in order. Words are numbered from the most frequent in the block, ties as first met.

    The name is a checksum of the texts, so that a text that reads differently another time is found out.
    """
    cut = regex.compile(pattern).findall
    task = TaskContext.get()
    nr, held = 0, 0
    # Pieces of texts: those that a blank precedes, and those that none does, which are numbered behind the others.
    later, first = _Numbers(), _Numbers()
    rows, ids, sums = [], [], xxh64()

    def close() -> Block:
        known = _Numbers()
        flat, lengths = array("I"), array("I")
        for piece in chain((" " + piece for piece in later), first):
            words = cut(piece)
            lengths.append(len(words))
            flat.extend(map(known.__getitem__, words))
        flat, lengths = np.array(flat, np.uint32), np.array(lengths, np.int64)
        parts = np.concatenate(rows) if rows else np.zeros(0, np.uint32)
        starts = np.cumsum([0, *map(len, rows)], dtype=np.int64)[:-1]
        parts[starts] += len(later)
        later.clear(), first.clear(), rows.clear()
        sizes = np.add.reduceat(lengths.astype(np.int32)[parts], starts, dtype=np.int64)
        words = pa.array(list(known), pa.string())
        known.clear()
        # Some parts at a time: the indices are larger than the numbers.
        numbers, counts, at = np.empty(int(sizes.sum()), np.uint32), np.zeros(len(words), np.int64), 0
        for start in range(0, len(parts), PARTS):
            some = ragged(parts[start:start + PARTS], flat, lengths)
            counts += np.bincount(some, minlength=len(words))
            numbers[at:at + len(some)] = some
            at += len(some)
        order = np.argsort(-counts, kind="stable")
        ranks = np.empty(len(words), dtype=np.uint32)
        ranks[order] = np.arange(len(words), dtype=np.uint32)
        np.take(ranks, numbers, out=numbers, mode="clip")
        sums.update(f"{task.partitionId() if task else 0} {nr}")
        return Block(sums.intdigest() >> 1, ids, words.take(pa.array(order)), sizes, numbers)

    for batch in sized_batches(batches, BLOCK // 8):
        for text in batch.column("text").to_pylist():
            text = text or ""
            sums.update(text)
            if not parted:
                rows.append(np.array([first[text]], dtype=np.uint32))
                continue
            start, *rest = pieces_of(text)
            row = np.empty(len(rest) + 1, dtype=np.uint32)
            row[0] = first[start]
            row[1:] = list(map(later.__getitem__, rest))
            rows.append(row)
        # A copy: a slice would hold the texts that came with it.
        ids.append(batch.column("doc_id").take(pa.array(np.arange(batch.num_rows))))
        held += batch.nbytes
        if held >= BLOCK:
            yield close()
            nr, held = nr + 1, 0
            rows, ids, sums = [], [], xxh64()
    if rows:
        yield close()


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def _unpacked(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def encode(
    docs: DataFrame, path: str, pattern: str, parted: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, ids``: the token ids of every row's whole text, without special tokens.

    ``parted`` says that a blank between two characters that are no white space always begins a match of the pattern, so that
    texts may be cut there and each distinct piece of a block matched once. A null or empty text has no ids. Repeated rows and
    null ids are rows like any other. ``docs`` is read twice and has to give
    the same rows in the same splits both times, as a stored table does; a block that differs stops the job.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(ranks(path))  # the rank file's size
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    narrow = "<u2" if max(table.value.values(), default=0) < 1 << 16 else "<u4"

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, pattern, parted):
            name, words = block.name, block.words
            del block
            for start in range(0, len(words), 50_000):
                some = words.slice(start, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), name)), pa.array(np.arange(start, start + len(some), dtype=np.int32)), some],
                    ["block", "nr", "word"])

    def numbers_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, pattern, parted):
            n = len(block.sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block.name)), pa.array(np.arange(n, dtype=np.int32)), pa.concat_arrays(block.ids),
                 pa.array(block.sizes), pa.array([_packed(block.numbers)] + [None] * (n - 1), pa.binary())],
                ["block", "place", "doc_id", "words", "numbers"])

    def ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by word. What goes back to a block is packed: numbers of words, how many ids each has, the ids."""
        rank, last, coded = table.value, None, b""
        blocks, nrs, codes = [], [], []

        def flush() -> pa.RecordBatch:
            names = np.concatenate(blocks)
            order = np.argsort(names, kind="stable")
            names, numbers = names[order], np.concatenate(nrs)[order]
            bounds = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
            packed = []
            for a, b in zip(bounds, [*bounds[1:], len(names)], strict=True):
                some = [codes[i] for i in order[a:b].tolist()]
                packed.append((_packed(numbers[a:b]), _packed(np.array([len(c) for c in some])), zstandard.compress(b"".join(some), 3)))
            blocks.clear(), nrs.clear(), codes.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(names[bounds]), *(pa.array(list(x), pa.binary()) for x in zip(*packed, strict=True))], ["block", "nrs", "sizes", "ids"])

        for batch in batches:
            for word in batch.column("word").to_pylist():
                if word != last:
                    last, coded = word, np.array(encode_word(word.encode(), rank), dtype=narrow).tobytes()
                codes.append(coded)
            blocks.append(batch.column("block").to_numpy())
            nrs.append(batch.column("nr").to_numpy())
            if len(codes) > PACKED:
                yield flush()
        if codes:
            yield flush()

    def joined(documents: pa.Table, words: pa.Table) -> pa.Table:
        documents = documents.sort_by("place")
        sizes = documents.column("words").to_numpy()
        blob = next((b for b in documents.column("numbers").to_pylist() if b is not None), None)
        numbers = _unpacked(blob) if blob and sizes.sum() else np.zeros(0, np.uint32)
        parts = [list(map(read, words.column(c).to_pylist())) for c, read in (
            ("nrs", _unpacked), ("sizes", _unpacked), ("ids", lambda x: np.frombuffer(zstandard.decompress(x), dtype=narrow)))]
        nrs, lengths, pool = (np.concatenate(p) if p else np.zeros(0, np.uint32) for p in parts)
        order = np.argsort(nrs)
        lengths = lengths.astype(np.int64) // np.dtype(narrow).itemsize
        if len(nrs) != (int(numbers.max()) + 1 if len(numbers) else 0) or sizes.sum() != len(numbers):
            raise RuntimeError("the documents changed between two reads; store them first")
        pool, lengths = ragged(order, pool, lengths), lengths[order]
        edges, lists = np.cumsum([0, *sizes]), []
        # Some documents at a time: the indices are larger than the ids.
        for start in range(0, len(sizes), 256):
            end = min(start + 256, len(sizes))
            some = numbers[edges[start]:edges[end]]
            ends = np.concatenate(([0], np.cumsum(lengths[some])))[edges[start:end + 1] - edges[start]]
            lists.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ragged(some, pool, lengths).astype(np.int32))))
        ids = pa.chunked_array(lists, type=pa.list_(pa.int32()))
        return pa.table([documents.column("doc_id"), ids], names=["doc_id", "ids"])

    words = rows.mapInArrow(words_of, "block bigint, nr int, word string")
    met = words.repartition("word").sortWithinPartitions("word")
    ids = met.mapInArrow(ids_of, "block bigint, nrs binary, sizes binary, ids binary")
    blocks = rows.mapInArrow(numbers_of, f"block bigint, place int, doc_id {kind}, words bigint, numbers binary")
    return blocks.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(joined, f"doc_id {kind}, ids array<int>")


def _digest(ids: np.ndarray) -> str:
    from hashlib import sha256

    return sha256(ids.astype("<u4").tobytes()).hexdigest()


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, n_tokens, ids_sha256, decoded``: the bytes that the ids stand for, with their number and digest.

    No or null ids give no bytes; an id that the table lacks stops the job.
    """
    spark = encoded.sparkSession
    own = ranks(path)
    listed: list[bytes | None] = [None] * (max(own.values()) + 1)
    for token, rank in own.items():
        listed[rank] = token
    table = spark.sparkContext.broadcast(listed)  # the rank file's size
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = table.value.__getitem__
        for batch in sized_batches(batches):
            counts, digests, texts = [], [], []
            for value in batch.column("ids"):
                ids = value.values.to_numpy(zero_copy_only=False) if value.is_valid else np.zeros(0, np.int32)
                counts.append(len(ids))
                digests.append(_digest(ids))
                texts.append(b"".join(map(token, ids.tolist())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(texts, pa.binary())], ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded"])

    return rows.mapInArrow(each, f"doc_id {kind}, ids array<int>, n_tokens bigint, ids_sha256 string, decoded binary")
