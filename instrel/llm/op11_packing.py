"""Bounded-space online packing of token ids into sequences.

Each partition reads its documents once, in order, and holds a fixed number of
open windows. What a document has beyond whole windows, which it fills alone, is
placed best-fit: into the open window with the least room that takes it. When
none does and the windows are all in use, the fullest is emitted: if its room is
``least`` ids or more, the head of the waiting piece fills it, else it is padded.
What is still open when a partition ends is merged: the windows of ``FAN``
partitions at a time are packed again, longest piece first, until one group is
left, whose last ids are cut at powers of two. So a task never holds more than
``FAN`` times the open windows, whatever the table's size.

Ids are those of the ``tokenizers`` library. Where a file's merges stand in the
order of their ids, merging by rank gives the same ids, and characters below
U+0250 are of the same classes in every version of Unicode; texts of those are
encoded by ``tiktoken`` with the file's own vocabulary as ranks, at a quarter of
the time, all others by ``tokenizers`` itself. A space before a character that is
no white space always starts a pre-token, so long texts are encoded in parts.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instrel.llm.common import key_and_text, sized_batches, stored

SIZE = 1024
#: Open windows of a partition.
OPEN = 32
#: Partitions whose open windows are packed together.
FAN = 16
#: The smallest head that is cut off to fill a window.
LEAST = 16
#: Fixed value: the id that ends a document.
END_ID = 0
#: Fixed value: how byte-level BPE splits texts into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that are encoded at once, about.
LONG = 100_000

_BYTES = 4
_START, _OTHER = re.compile(r" (?=\S)"), re.compile("[^\x00-\u024F]")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 as it is, the others from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.path = path
        self.ranked = self._ranked()

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = True  # a special token's string in a text is ordinary text
        return found

    def _ranked(self):
        """An encoding by ranks if the file's merges stand in the order of the ids they give and its texts are split by ``PATTERN``; else None."""
        import json

        import tiktoken

        with open(self.path, encoding="utf-8") as file:
            held = json.load(file)
        model, split = held["model"], held["pre_tokenizer"] or {}
        plain = held["normalizer"] is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        if model["type"] != "BPE" or not plain or model.get("dropout") or model.get("ignore_merges"):
            return None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        if made != sorted(set(made)) or len(made) + 256 != len(model["vocab"]):
            return None
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): number for token, number in model["vocab"].items()}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def cut(text: str, most: int) -> list[str]:
        """The text in parts of ``most`` characters or more, each but the first from a space on that a character other than white space follows."""
        parts, start = [], 0
        while len(text) - start > most:
            found = _START.search(text, start + most)
            if not found:
                break
            parts.append(text[start:found.start()])
            start = found.start()
        return [*parts, text[start:]]

    def encode(self, text: str) -> bytes:
        parts = self.cut(text, LONG)
        if self.ranked and not _OTHER.search(text):
            return b"".join(self.ranked.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in parts)
        return b"".join(np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes() for p in parts)


@cache
def encoder(path: str) -> Encoder:
    """The worker's own, kept for its next tasks."""
    return Encoder(path)


class Windows:
    """A fixed number of open windows. Pieces are ``(document, start, ids, ids of the document)``, ids as bytes."""

    def __init__(self, size: int, most: int, least: int, first_id: int):
        self.size, self.most, self.least, self.next_id = size, most, least, first_id
        self.rooms: list[tuple[int, int]] = []  # room and number of each open window, in order
        self.held: dict[int, list] = {}
        self.sealed: list[tuple] = []

    def _emit(self, pieces: list) -> None:
        offset = 0
        for document, start, ids, total in pieces:
            self.sealed.append((document, start, ids, total, self.next_id, offset))
            offset += len(ids) // _BYTES
        self.next_id += 1

    def add(self, document, start: int, ids: bytes, total: int) -> None:
        """Place a piece of any length."""
        whole = self.size * _BYTES
        while len(ids) >= whole:
            self._emit([(document, start, ids[:whole], total)])
            start, ids = start + self.size, ids[whole:]
        while ids:
            length = len(ids) // _BYTES
            at = bisect_left(self.rooms, (length, -1))
            if at < len(self.rooms):
                room, nr = self.rooms.pop(at)
            elif len(self.rooms) < self.most:
                room, nr = self.size, max(self.held, default=-1) + 1
                self.held[nr] = []
            else:
                room, nr = self.rooms.pop(0)
                if room < self.least:
                    self._emit(self.held.pop(nr))
                    continue
            taken = min(room, length)
            self.held[nr].append((document, start, ids[:taken * _BYTES], total))
            start, ids = start + taken, ids[taken * _BYTES:]
            if taken == room:
                self._emit(self.held.pop(nr))
            else:
                insort(self.rooms, (room - taken, nr))

    def drain(self) -> list[tuple]:
        """The pieces of the open windows, which are then gone."""
        pieces = [p for nr in sorted(self.held) for p in self.held[nr]]
        self.held, self.rooms = {}, []
        return pieces

    def close(self) -> None:
        """Emit all that is open: full sequences, then sequences of falling powers of two."""
        pieces = self.drain()
        left = sum(len(p[2]) for p in pieces) // _BYTES
        while left:
            length = min(self.size, 1 << (left.bit_length() - 1))
            sequence, need = [], length * _BYTES
            while need:
                document, start, ids, total = pieces.pop(0)
                if len(ids) > need:
                    pieces.insert(0, (document, start + need // _BYTES, ids[need:], total))
                    ids = ids[:need]
                sequence.append((document, start, ids, total))
                need -= len(ids)
            self._emit(sequence)
            left -= length


_FIELDS = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, open_in bigint"


def _batch(kind: pa.DataType, sealed: list[tuple], left: list[tuple], group: int) -> pa.RecordBatch:
    """Rows of pieces; ``open_in`` is null for those of emitted windows, else the group whose windows hold them."""
    rows = sealed + [(*p, None, None) for p in left]
    documents, starts, ids, totals, sequences, offsets = zip(*rows, strict=True) if rows else ((),) * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(documents, kind), pa.array(starts, pa.int64()), pa.array([len(x) // _BYTES for x in ids], pa.int64()),
         pa.array(ids, pa.binary()), pa.array(totals, pa.int64()), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64()),
         pa.array([None] * len(sealed) + [group] * len(left), pa.int64())],
        ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "open_in"])


def _first_id(step: int, group: int) -> int:
    """Sequences are numbered by merging round, group and place: 2^25 groups of 2^31 sequences each."""
    return step << 56 | group << 31


def _packed(rows: DataFrame, path: str, size: int, most: int, least: int) -> DataFrame:
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([END_ID], dtype="<u4").tobytes()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, encode = TaskContext.get().partitionId(), encoder(path).encode
        windows = Windows(size, most, least, _first_id(0, group))
        of = None
        for batch in sized_batches(batches):
            of = batch.schema.field("doc_id").type
            for document, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encode(text or "") + end
                windows.add(document, 0, ids, len(ids) // _BYTES)
            yield _batch(of, windows.sealed, [], group)
            windows.sealed = []
        if of is not None:
            yield _batch(of, [], windows.drain(), group)

    return rows.mapInArrow(each, f"doc_id {kind}, {_FIELDS}")


def _merged(pieces: DataFrame, step: int, last: bool, size: int, most: int, least: int) -> DataFrame:
    """Open pieces packed again, ``FAN`` groups at a time; what stays open goes on to the next step unless it is the last.

    A group holds ``FAN`` x ``most`` windows of less than ``size`` ids.
    """
    def each(table: pa.Table) -> pa.Table:
        of, group = table.schema.field("doc_id").type, table.column("group")[0].as_py()
        windows = Windows(size, most, least, _first_id(step, group))
        rows = zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True)
        # Equal keys are copies of one row, so every run gives the same sequences.
        for piece in sorted(rows, key=lambda p: (-len(p[2]), p[0] is None, p[0] or 0, p[1], p[2])):
            windows.add(*piece)
        if last:
            windows.close()
        return pa.Table.from_batches([_batch(of, windows.sealed, windows.drain(), group)])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    grouped = pieces.withColumn("group", F.expr(f"open_in div {FAN}"))
    return grouped.groupBy("group").applyInArrow(each, f"doc_id {kind}, {_FIELDS}")


def pack(
    docs: DataFrame, path: str, size: int = SIZE, open_windows: int = OPEN, least: int = LEAST,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row for each piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit integers, ``start`` counts the ids of the document before the piece, ``doc_tokens``
    its ids with the one that ends it, ``offset`` the ids before the piece in its sequence. ``path`` names a byte-level BPE of the
    ``tokenizers`` library on all machines. Every id of every row is in one piece. A null or empty text is the end id alone;
    repeated rows and null ids are documents of their own; an empty table gives none. Emitted sequences hold more than ``size - least``
    ids, or a power of two. The first pass is stored, so lost executors never renumber what was merged.
    """
    rows = key_and_text(docs, id_col, text_col)
    steps = [stored(_packed(rows, path, size, open_windows, least), "packed")]
    groups = steps[0].agg(F.max("open_in")).first()[0]
    while groups is not None:
        groups //= FAN
        last = groups == 0
        steps.append(stored(_merged(
            steps[-1].where("open_in is not null"), len(steps), last, size, open_windows, least), "merged"))
        if last:
            break
    found = steps[0]
    for step in steps[1:]:
        found = found.unionByName(step)
    return found.where("open_in is null").drop("open_in")
