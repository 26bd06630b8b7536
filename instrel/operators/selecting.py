"""Threshold selection inside each package, and its summary. No shuffle but in the summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instrel.constants import (
    BOTTOM_NEGATIVES, NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD, PREVIEW_CHARS, PREVIEW_ROWS,
)
from instrel.functions.nested import members
from instrel.functions.once import with_once
from instrel.functions.selection import bottom_ranks, top_rank, with_response
from instrel.operators.distributions import any_score


def ranked_positions(
    packages: DataFrame,
    positive: float = POSITIVE_THRESHOLD,
    negative: float = NEGATIVE_THRESHOLD,
    k: int = BOTTOM_NEGATIVES,
    respect_label: bool = False,
) -> DataFrame:
    """Packages with ``top`` and ``bottom``: positions and scores only, no texts are read."""
    scores = F.col("responses.confidence")
    labels = F.col("responses.label") if respect_label else None
    return with_once(packages, top=top_rank(scores, labels, positive), bottom=bottom_ranks(scores, labels, negative, k))


def select_responses(
    packages: DataFrame,
    positive: float = POSITIVE_THRESHOLD,
    negative: float = NEGATIVE_THRESHOLD,
    k: int = BOTTOM_NEGATIVES,
    respect_label: bool = False,
) -> DataFrame:
    """Every package with its best passage, its worst passages and all passages."""
    ranked = ranked_positions(packages, positive, negative, k, respect_label)
    responses = F.col("responses")
    return ranked.select(
        "id", "choice_index", "query",
        with_response(F.col("top"), responses).alias("top_positive"),
        F.transform("bottom", lambda rank: with_response(rank, responses)).alias("bottom_negatives"),
        responses.alias("all_responses"),
    )


def selection_summary(
    packages: DataFrame, positive: float = POSITIVE_THRESHOLD, negative: float = NEGATIVE_THRESHOLD
) -> DataFrame:
    """One row: thresholds, packages, and how many have a best passage / a worst passage."""
    counted = packages.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if(any_score(lambda score: score >= positive)).alias("with_positive"),
        F.count_if(any_score(lambda score: score <= negative)).alias("with_negatives"),
    )
    return counted.select(
        F.lit(positive).alias("positive_threshold"),
        F.lit(negative).alias("negative_threshold"),
        "*",
        (F.col("with_positive") / F.col("total_queries") * 100).alias("positive_percent"),
        (F.col("with_negatives") / F.col("total_queries") * 100).alias("negative_percent"),
    )


def selection_preview(packages: DataFrame, n: int = PREVIEW_ROWS, chars: int = PREVIEW_CHARS) -> DataFrame:
    """A few packages for reading: shortened query, best score and worst scores."""
    first = packages.select("id", "choice_index", "query", members("responses", "confidence").alias("responses"))
    ranked = ranked_positions(first.orderBy("id", "choice_index").limit(n))
    return ranked.select(
        "id", "choice_index",
        F.concat(F.substring("query", 1, chars), F.lit("...")).alias("query_preview"),
        F.round(F.col("top.confidence"), 3).alias("top_confidence"),
        F.size("bottom").alias("negatives"),
        F.array_join(
            F.transform("bottom", lambda b: F.format_number(b["confidence"], 3)), ", "
        ).alias("negative_confidences"),
    )
