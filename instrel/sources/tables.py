"""CSV and Parquet tables.

CSV is cut into records by many tasks and the records are written to the shared
folder once (``records``), so reading runs when a table is asked for, not when it
is used. Use ``read_csv`` and the functions on what it gives where a table and
its rejects are both wanted.
"""

from __future__ import annotations

import csv
import time
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from instrel.constants import CSV_MISSING, PACKAGE_COLUMNS, QA_METADATA
from instrel.functions.once import with_once
from instrel.schemas import packages
from instrel.sources.records import read_records

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
_QA_NAMES = {
    "ID": "id", "Question": "question", "Answer": "answer", "chunk": "chunk",
    "Keywords": "keywords", "SE_penalized": "se_penalized", "Cluster_labels": "cluster_labels",
}


def _missing_to_null(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.when(~F.col(f"`{c}`").isin(CSV_MISSING), F.col(f"`{c}`")).alias(c) for c in df.columns]
    )


_RECORD = "_bad_record"


def _names(header: str, positional: list[str] | None) -> list[str]:
    names = next(csv.reader([header.removeprefix("\ufeff")], strict=True))
    if positional and set(names) != set(positional):
        if len(names) != len(positional):
            raise ValueError(f"a header has {len(names)} columns, not {len(positional)}: {header[:200]}")
        names = positional
    if len(set(names)) < len(names):
        raise ValueError(f"a header repeats a column: {header[:200]}")
    return names


def _ddl(names: list[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` string" for name in names)


def read_csv(spark: SparkSession, path: str, positional: list[str] | None = None) -> DataFrame:
    """All records of a folder, each file read by its own header, with ``_bad_record``: the text of a record with too many or

    too few fields, else NULL. ``positional`` renames the columns of files whose header has other names.
    The driver gets the distinct headers; which file has which stays with the executors.
    """
    records = read_records(spark, path)
    heads = records.where("first").select("file", F.col("record").alias("header"))
    headers = sorted(r.header for r in heads.select("header").distinct().collect())
    if not headers:
        raise ValueError(f"{path} has no CSV file")
    parts = []
    for header in headers:
        rows = records.where("not first")
        if len(headers) > 1:
            rows = rows.join(heads.where(F.col("header") == header).select("file"), "file", "left_semi")
        names = _names(header, positional)
        fields = F.from_csv("record", _ddl([*names, _RECORD]), {**_CSV, "columnNameOfCorruptRecord": _RECORD})
        parsed = with_once(rows.select("record", "too_long"), fields=fields)
        bad = F.when(F.col("too_long"), F.col("record")).otherwise(F.col(f"fields.{_RECORD}"))
        parts.append(parsed.select(*[F.col("fields")[name].alias(name) for name in names], bad.alias(_RECORD)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def rejects_of(read: DataFrame, stage: str = "csv", id_col: str = "ID") -> DataFrame:
    """Records of ``read_csv`` that do not fit their file's header, in the form of all rejects; the id is what stands in its column."""
    known = F.col(f"`{id_col}`") if id_col in read.columns else F.lit(None)
    return read.where(F.col(_RECORD).isNotNull()).select(
        F.lit(stage).alias("stage"), known.cast("string").alias("id"), F.lit(None).cast("int").alias("choice_index"),
        F.lit("bad_record").alias("reason"), F.col(_RECORD).alias("raw"))


def csv_rejects(spark: SparkSession, path: str, stage: str = "csv", positional: list[str] | None = None, id_col: str = "ID") -> DataFrame:
    return rejects_of(read_csv(spark, path, positional), stage, id_col)


def _good(read: DataFrame) -> DataFrame:
    return read.where(F.col(_RECORD).isNull()).drop(_RECORD)


def qa_of(read: DataFrame) -> DataFrame:
    """Q&A rows of ``read_csv``; the columns ID, Question and Answer must be there. Records that do not fit are in ``rejects_of``."""
    raw = _good(read)
    absent = {"ID", "Question", "Answer"} - set(raw.columns)
    if absent:
        raise ValueError(f"the columns {sorted(absent)} are missing")
    known = _missing_to_null(raw.select(*[f"`{c}`" for c in raw.columns if c in _QA_NAMES]))
    return known.withColumnsRenamed(_QA_NAMES)


def read_qa(spark: SparkSession, path: str) -> DataFrame:
    """Q&A rows from CSV."""
    return qa_of(read_csv(spark, path))


def drop_metadata(qa: DataFrame, keep_id: bool = True) -> DataFrame:
    """Leave out the columns that carry no prompt text; the id is needed downstream."""
    names = set(QA_METADATA) | {_QA_NAMES[c] for c in QA_METADATA}
    if keep_id:
        names -= {"ID", "id"}
    return qa.drop(*[c for c in qa.columns if c in names])


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """Package text table from CSV, columns named by position unless the header has the table's own names in some order."""
    return _missing_to_null(_good(read_csv(spark, path, PACKAGE_COLUMNS)).select(*PACKAGE_COLUMNS))


def read_package_parquet(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Nested package table, the form the operators work on; ``id_type`` is the type its ids were written with."""
    return spark.read.schema(packages(id_type)).parquet(path)


#: Parts in which the rows of one id are numbered.
_PARTS = 64


def package_rows(read: DataFrame) -> DataFrame:
    """What the parsers take, from ``read_packages``: id, choice_index, query, og_positive, instruction, response.

    A CSV file has no choice number. It is the row's place among the rows of its id in the order of a hash of all
    columns, so it does not depend on how the rows were read; equal rows are numbered on. Hashes are numbered in
    parts, so that an id of very many rows is the work of many tasks. The texts are shuffled once.
    """
    # In a struct null ids are equal, so that copies are dropped and joined by the same key.
    rows = read.withColumns({"_key": F.struct("ID"), "_hash": F.xxhash64("Instruction", "Response", "Query", "OgPositive")})
    part = F.pmod(F.shiftrightunsigned("_hash", 58), F.lit(_PARTS)).cast("int").alias("_part")
    counts = rows.groupBy(F.col("_key").alias("_id"), "_hash", part).agg(F.count(F.lit(1)).alias("_copies"))
    before = Window.partitionBy("_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.groupBy("_id", "_part").agg(F.sum("_copies").alias("_held")).select(
        F.col("_id").alias("_of"), F.col("_part").alias("_in"), F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_id", "_part").orderBy("_hash").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.withColumn("_ahead", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(
        offsets, (F.col("_id") == F.col("_of")) & (F.col("_part") == F.col("_in"))).select(
        "_id", F.col("_hash").alias("_same"), (F.col("_offset") + F.col("_ahead")).alias("_first"), "_copies")
    numbered = rows.dropDuplicates(["_key", "_hash"]).join(ahead, (F.col("_key") == F.col("_id")) & (F.col("_hash") == F.col("_same")))
    place = F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)).alias("choice_index")
    return numbered.select(F.col("ID").alias("id"), place, "Query", "OgPositive", "Instruction", "Response").select(
        "id", F.col("choice_index").cast("int"), F.col("Query").alias("query"), F.col("OgPositive").alias("og_positive"),
        F.col("Instruction").alias("instruction"), F.col("Response").alias("response"))


def csv_to_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Write a table read from CSV once as Parquet, evenly spread over ``partitions`` files."""
    (df.repartition(partitions) if partitions else df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with quotes doubled inside quoted fields, as ``read_packages`` expects."""
    df.write.options(header="true", quote='"', escape='"', quoteAll="true").mode("overwrite").csv(path)


def append_packages(df: DataFrame, path: str, max_rows_per_file: int = 0) -> dict[str, float]:
    """Append rows to a Parquet table; returns rows written, seconds and rows per second."""
    start = time.monotonic()
    progress = Observation("append_packages")
    observed = df.observe(progress, F.count(F.lit(1)).alias("rows"))
    observed.write.option("maxRecordsPerFile", max_rows_per_file).mode("append").parquet(path)
    rows, seconds = progress.get["rows"], time.monotonic() - start
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else 0.0}


def write_filtered(df: DataFrame, path: str) -> None:
    """Replace the flat table of kept passages."""
    df.write.mode("overwrite").parquet(path)
