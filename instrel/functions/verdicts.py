"""Relevance verdict from a pair of logits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relevance_verdict(true_logit: Column, false_logit: Column) -> Column:
    """Struct (is_relevant, confidence): two-way softmax, a tie is not relevant, nor is a NaN (which Spark orders above all numbers)."""
    p_true = F.lit(1.0) / (F.lit(1.0) + F.exp(false_logit - true_logit))
    return F.struct(
        ((true_logit > false_logit) & ~F.isnan(true_logit)).alias("is_relevant"),
        F.greatest(p_true, F.lit(1.0) - p_true).alias("confidence"),
    )


def routing_bucket(label: Column, query_relevant: Column, instruction_relevant: Column) -> Column:
    """Where a passage goes, given its label and both verdicts.

    A positive has to be relevant with and without the instruction, a negative
    only without it. A passage with any other label is ``unlabelled``, one without
    verdicts ``unscored``.
    """
    kept_positive = query_relevant & instruction_relevant
    kept_negative = query_relevant & ~instruction_relevant
    return (
        F.when(query_relevant.isNull() | instruction_relevant.isNull(), "unscored")
        .when((label == "positive") & kept_positive, "valid_positive")
        .when(label == "positive", "discarded_positive")
        .when((label == "negative") & kept_negative, "valid_negative")
        .when(label == "negative", "discarded_negative")
        .otherwise("unlabelled")
    )
