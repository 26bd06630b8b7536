"""New Q&A files in, requests out, each input once.

``run_requests`` is a projection into the file sink, which writes each batch exactly
once: a run that is cut off resumes from the checkpoint, repeats nothing and leaves
nothing out. ``run_requests_once`` asks each id once as well, however many files
hold it: a batch's requests are those of ids that no earlier batch has asked, and
they are appended under an id that the stream's own id and the batch's number
make, so a batch that comes again after a crash adds nothing.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from instrel.operators.incremental import pending
from instrel.plans.flows import Prompts, instruction_requests
from instrel.sources.batches import append_batch, read_batches

QA_SCHEMA = "id bigint, question string, answer string, chunk string"
#: Name under which a stream counts the rows it writes, and seconds within which its end is reported.
_WRITTEN, _REPORTED_WITHIN = "written", 60
REQUEST_COLUMNS = ["request_id", "id", "style", "length", "prompt", "body"]


def request_stream(
    spark: SparkSession, qa_path: str, prompts: Prompts, schema: str = QA_SCHEMA,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming request table over the Parquet files of a folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return instruction_requests(reader.parquet(qa_path), prompts).select(*REQUEST_COLUMNS)


def start_requests(stream: DataFrame, out_path: str, checkpoint: str) -> StreamingQuery:
    """Write what is there now, then stop."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out_path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


class _RowCounter(StreamingQueryListener):
    """Adds up the rows that a query's batches have written, as the query itself observes them."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        run, seen = str(event.progress.runId), event.progress.observedMetrics.get(_WRITTEN)
        if seen is not None:
            self.rows[run] = self.rows.get(run, 0) + seen["rows"]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.setdefault(str(event.runId), threading.Event()).set()


def run_requests(
    spark: SparkSession, qa_path: str, out_path: str, checkpoint: str, prompts: Prompts,
    schema: str = QA_SCHEMA, max_files: int | None = None,
) -> dict[str, float]:
    """Run to the end of the available files; requests written, seconds, and requests per second.

    The rows are counted as they are written and reported batch by batch; nothing that was written is read.
    """
    counter = _RowCounter()
    spark.streams.addListener(counter)
    try:
        start = time.monotonic()
        stream = request_stream(spark, qa_path, prompts, schema, max_files).observe(_WRITTEN, F.count(F.lit(1)).alias("rows"))
        running = start_requests(stream, out_path, checkpoint)
        running.awaitTermination()
        seconds, run = time.monotonic() - start, str(running.runId)
        # Reports come in order, that of the end last.
        if not counter.ended.setdefault(run, threading.Event()).wait(_REPORTED_WITHIN):
            raise TimeoutError("the stream has ended but did not report it")
        return _rate(counter.rows.get(run, 0), seconds)
    finally:
        spark.streams.removeListener(counter)


def _rate(rows: int, seconds: float) -> dict[str, float]:
    return {"rows": rows, "seconds": seconds, "rows_per_second": rows / seconds if seconds else 0.0}


def run_requests_once(
    spark: SparkSession, qa_path: str, out_path: str, checkpoint: str, prompts: Prompts,
    schema: str = QA_SCHEMA, max_files: int | None = None,
) -> dict[str, float]:
    """As ``run_requests``, but an id that several files or rows hold is asked once; ``read_batches`` reads the requests.

    Of an id's rows in one batch the one of the smallest hash is asked. The ids that earlier batches have asked are read,
    without their texts, to be left out.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    asked: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        name = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        own = F.xxhash64(*batch.columns)
        first = batch.groupBy("id").agg(F.min_by(F.struct(*batch.columns), own).alias("row")).select("row.*")
        earlier = read_batches(session, out_path, "id " + batch.schema["id"].dataType.simpleString()).where(F.col("batch_id") != name)
        fresh = pending(first, earlier)
        asked.append(append_batch(instruction_requests(fresh, prompts).select(*REQUEST_COLUMNS), out_path, name)["rows"])

    start = time.monotonic()
    running = reader.parquet(qa_path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()
    return _rate(sum(asked), time.monotonic() - start)


def read_requests(spark: SparkSession, out_path: str) -> DataFrame:
    """What the stream has written, by its own log of finished files."""
    return spark.read.parquet(out_path)
