"""Records of CSV files whose quoted fields may hold line ends, read by as many tasks as the files have blocks.

The text source gives lines, in order, of each block of a file. A line either
starts outside of quotes or inside; what it does to that is told by two patterns,
one for each start, and comes to one of four codes. A first pass sees the codes
only and joins those of a block to one. Going through a file's blocks, a few bytes
for each, then tells which blocks start inside quotes. With that a second pass
cuts each block at its true record ends, all blocks at once. What is left over, the
last record of a block that ends inside quotes and the lines up to the end of that
record in the blocks behind, is put together by the block it starts in.

The records are written to the shared folder once: later reads of a table do not cut
them again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from instrel.session import shared_dir

#: Characters of a record that ends in another block than it starts in; longer ones are not put together.
LONGEST = 1 << 24
#: Characters of a record that was not put together which its reject shows.
SHOWN = 1000

WHOLE, TAIL, HEAD = 0, 1, 2

# Quoted content is anything but a quote, and pairs of quotes; a field that does not start with a quote takes quotes as they are.
# All repetitions are possessive, so that no line is looked at twice.
_CONTENT = '[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:"{_CONTENT}"[^,]*+|[^",][^,]*+)?+,)*+'
_OUTSIDE_TO_INSIDE = rf'\A{_FIELDS}"{_CONTENT}\z'
_INSIDE_TO_INSIDE = rf'\A{_CONTENT}(?:"[^,]*+,{_FIELDS}"{_CONTENT})?+\z'
#: A line, or a block, that leaves things as they are: outside stays 0, inside stays 1.
_SAME = 2


def _code(line: Column) -> Column:
    """1 if a line that starts outside of quotes ends inside, plus 2 if one that starts inside does."""
    found = line.rlike(_OUTSIDE_TO_INSIDE).cast("int") + 2 * line.rlike(_INSIDE_TO_INSIDE).cast("int")
    return F.when(F.contains(line, F.lit('"')), found).otherwise(F.lit(_SAME))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        _code(F.col("value")).cast("tinyint").alias("code"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """The (file, block) of each run of rows of one block, with its first row and the row behind its last."""
    file, block = batch.column("file").to_numpy(), batch.column("block").to_numpy()
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
    for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
        if end > start:
            yield (int(file[start]), int(block[start])), start, end


def _after(code: int, codes: np.ndarray) -> int:
    """The code of lines behind ``code``, in one."""
    for c in codes[codes != _SAME].tolist():
        code = (c >> (code & 1) & 1) | (c >> (code >> 1) & 1) << 1
    return code


def blocks(lines: DataFrame) -> DataFrame:
    """``file, block, code`` of each block."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, code, found = None, _SAME, []
        for batch in batches:
            codes = batch.column("code").to_numpy()
            for key, start, end in _runs(batch):
                if key != now:
                    found += [(*now, code)] if now else []
                    now, code = key, _SAME
                code = _after(code, codes[start:end])
        found += [(*now, code)] if now else []
        file, block, code = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(file, pa.int64()), pa.array(block, pa.int64()), pa.array(code, pa.int8())], ["file", "block", "code"])

    return lines.select("file", "block", "code").mapInArrow(each, "file bigint, block bigint, code tinyint")


def inside_blocks(coded: DataFrame) -> DataFrame:
    """``file, block`` of the blocks that start inside quotes. A file's blocks, some bytes each, meet in one task."""
    def each(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        inside, starts = 0, []
        for block, code in zip(table.column("block").to_pylist(), table.column("code").to_pylist(), strict=True):
            if inside:
                starts.append(block)
            inside = code >> inside & 1
        return pa.table({"file": pa.array(table.column("file").to_pylist()[:1] * len(starts), pa.int64()), "block": pa.array(starts, pa.int64())})

    return coded.groupBy("file").applyInArrow(each, "file bigint, block bigint")


def _pieces(lines: DataFrame, inside: set[tuple[int, int]]) -> DataFrame:
    """``file, block, kind, first, record``: whole records, a block's open last one (``TAIL``), and its lines before its first (``HEAD``).

    ``first`` marks the first record of a file.
    """
    sent = lines.sparkSession.sparkContext.broadcast(inside)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, held, kind, fresh = None, 0, [], WHOLE, False
        out: list[tuple] = []

        def close(ended: bool) -> None:
            """What is held becomes a record or a piece of one."""
            nonlocal held, kind, fresh
            if held and (kind == HEAD or not ended or held[0] not in ("", "\r")):
                out.append((*now, kind if kind == HEAD else WHOLE if ended else TAIL, fresh, "\n".join(held)))
                fresh = fresh and kind == HEAD
            held, kind = [], WHOLE

        def batch_of() -> pa.RecordBatch:
            file, block, kinds, first, records = zip(*out, strict=True) if out else ((),) * 5
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(file, pa.int64()), pa.array(block, pa.int64()), pa.array(kinds, pa.int8()), pa.array(first, pa.bool_()),
                 pa.array(records, pa.string())], ["file", "block", "kind", "first", "record"])

        for batch in batches:
            codes, values = batch.column("code").to_numpy(), batch.column("value").to_pylist()
            for key, start, end in _runs(batch):
                if key != now:
                    close(False)
                    now, state = key, int(key in sent.value)
                    kind, fresh = HEAD if state else WHOLE, key[1] == 0
                for at in range(start, end):
                    held.append(values[at])
                    state = int(codes[at]) >> state & 1
                    if not state:
                        close(True)
            yield batch_of()
        close(False)
        yield batch_of()

    return lines.mapInArrow(each, "file bigint, block bigint, kind tinyint, first boolean, record string")


def _owners(pieces: DataFrame) -> DataFrame:
    """``file, block, kind, owner, size`` of the pieces of open records: the block where the record starts, and its characters in all."""
    order = Window.partitionBy("file").orderBy("block", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    keys = pieces.where(F.col("kind") != WHOLE).select("file", "block", "kind", F.length("record").cast("bigint").alias("size"))
    owned = keys.withColumn("owner", F.max(F.when(F.col("kind") == TAIL, F.col("block"))).over(order))
    totals = owned.groupBy("file", "owner").agg(F.sum("size").alias("total"))
    return owned.join(totals, ["file", "owner"]).select("file", "block", "kind", "owner", "total")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, record, too_long`` of all CSV records under ``path``; ``first`` marks the first record of each file.

    Fields are parted by commas and quoted by double quotes, which are doubled inside; a quote inside an unquoted field is as any character.
    Records end with a line feed, with or without a carriage return before it; empty ones are left out. A record that runs over
    from one block into others and has more than ``LONGEST`` characters, as after a quote that is never closed, is ``too_long`` and shows its
    first characters only. The driver holds two numbers for each block that starts inside quotes.
    """
    lines = _lines(spark, path)
    starts = inside_blocks(blocks(lines)).toArrow()
    inside = set(zip(starts.column("file").to_pylist(), starts.column("block").to_pylist(), strict=True))
    folder = shared_dir(spark, "records")
    pieces = _pieces(lines, inside)
    pieces.write.option("compression", "zstd").parquet(folder)
    pieces = spark.read.schema(pieces.schema).parquet(folder)
    found = pieces.where(F.col("kind") == WHOLE).select("file", "first", "record", F.lit(False).alias("too_long"))
    if not pieces.where(F.col("kind") != WHOLE).isEmpty():
        parts = pieces.where(F.col("kind") != WHOLE).join(_owners(pieces), ["file", "block", "kind"])
        # At most ``LONGEST`` characters meet for each record; of longer ones only where they start.
        usable = parts.where((F.col("total") <= LONGEST) | (F.col("kind") == TAIL))
        order = F.array_sort(F.collect_list(F.struct("block", (-F.col("kind")).alias("nr"), "record")))
        glued = usable.groupBy("file", "owner").agg(
            F.max("first").alias("first"), order.alias("parts"), (F.max("total") > LONGEST).alias("too_long")).select(
            "file", "first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), "too_long")
        found = found.unionByName(glued.withColumn(
            "record", F.when(F.col("too_long"), F.substring("record", 1, SHOWN)).otherwise(F.col("record"))))
    bare = F.when(F.endswith("record", F.lit("\r")), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return found.withColumn("record", bare).where("record <> ''")
