"""Which inputs to work on, and how far the work has come."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def limit_rows(qa: DataFrame, max_rows: int | None) -> DataFrame:
    """First ``max_rows`` inputs in id order; ``None`` or 0 means all of them."""
    return qa.orderBy("id").limit(max_rows) if max_rows else qa


def pending(qa: DataFrame, done: DataFrame) -> DataFrame:
    """Inputs whose id is not in ``done`` yet, so that a restart repeats nothing.

    The ids are made distinct before the shuffle: a restarted run may have
    appended one id many times.
    """
    return qa.join(done.select("id").distinct(), "id", "left_anti")


def head_sample(df: DataFrame, n: int, order: tuple[str, ...] = ("id", "choice_index")) -> DataFrame:
    """First ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)


def run_metrics(qa: DataFrame, packages: DataFrame, max_rows: int | None = None) -> DataFrame:
    """One row: inputs in total, inputs in this run, packages written, inputs without any."""
    inputs = qa.select("id")
    run = limit_rows(inputs, max_rows)
    written = packages.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    per_input = run.join(written, "id", "left").agg(
        F.count(F.lit(1)).alias("processed_rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("output_rows"),
        F.count_if(F.col("n").isNull()).alias("failed_rows"),
    )
    total = inputs.agg(F.count(F.lit(1)).alias("total_rows")).scalar()
    return per_input.select(total.alias("total_rows"), "processed_rows", "output_rows", "failed_rows")
