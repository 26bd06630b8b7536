"""Tables that grow by batches, each of which counts once however often it is written.

A batch's rows stand in a folder of its own, and a line in the table's manifest
names the batch once it is whole. Readers take the batches of the manifest only.
A batch that was cut off is not in it and is written over when it comes again; one
that is in it already is left as it is. So a caller that gives a batch the same
id when it tries again may try as often as it likes.
"""

from __future__ import annotations

import re
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "batch_id string, rows bigint, seconds double, columns string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """``batch_id, rows, seconds, columns`` of the whole batches; none if there is no table yet."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest").dropDuplicates(["batch_id"])
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], MANIFEST)


def append_batch(df: DataFrame, path: str, batch_id: str, max_rows_per_file: int = 0) -> dict[str, float]:
    """Append a batch unless the table has it; rows added, seconds and rows per second.

    ``batch_id`` holds letters, digits, dots, dashes and underscores only.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", batch_id):
        raise ValueError(f"no id of a batch: {batch_id!r}")
    spark = df.sparkSession
    if not manifest(spark, path).where(F.col("batch_id") == batch_id).isEmpty():
        return {"rows": 0, "seconds": 0.0, "rows_per_second": 0.0}
    start = time.monotonic()
    progress = Observation("append_batch")
    observed = df.observe(progress, F.count(F.lit(1)).alias("rows"))
    observed.write.option("maxRecordsPerFile", max_rows_per_file).mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
    rows, seconds = progress.get["rows"], time.monotonic() - start
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.createDataFrame([(batch_id, rows, seconds, columns)], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else 0.0}


def read_batches(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of all whole batches, with ``batch_id``; ``schema`` is that of the first batch unless given.

    The manifest is the small side of a join on the folder's id, so that folders that are not in it are not read.
    """
    whole = manifest(spark, path)
    if schema is None:
        first = whole.agg(F.min_by("columns", "batch_id")).first()[0]
        if first is None:
            raise ValueError(f"{path} has no whole batch")
        schema = first
    if whole.isEmpty():
        return spark.createDataFrame([], f"{schema}, batch_id string")
    rows = spark.read.schema(f"{schema}, batch_id string").parquet(f"{path}/rows")
    return rows.join(whole.select("batch_id"), "batch_id", "left_semi")
