"""Best and worst passages inside one package, as array expressions.

Ties go to the earlier position, as a stable sort would leave them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from instrel.constants import BOTTOM_NEGATIVES, NEGATIVE, NEGATIVE_THRESHOLD, POSITIVE, POSITIVE_THRESHOLD
from instrel.functions.scores import is_score


def top_rank(
    scores: Column, labels: Column | None = None, threshold: float = POSITIVE_THRESHOLD
) -> Column:
    """Struct (confidence, pos) of the highest score >= threshold, else NULL.

    With ``labels`` given, only passages labelled positive count; otherwise the
    label plays no part.
    """

    def rank(score: Column, i: Column) -> Column:
        wanted = (score >= threshold) & is_score(score)
        if labels is not None:
            wanted = wanted & (F.get(labels, i) == POSITIVE)
        return F.when(wanted, F.struct(score.alias("confidence"), (-i).alias("back")))

    best = F.array_max(F.transform(scores, rank))
    return F.when(
        best.isNotNull(), F.struct(best["confidence"].alias("confidence"), (-best["back"]).alias("pos"))
    )


def bottom_ranks(
    scores: Column,
    labels: Column | None = None,
    threshold: float = NEGATIVE_THRESHOLD,
    k: int = BOTTOM_NEGATIVES,
) -> Column:
    """Up to ``k`` structs (confidence, pos) with score <= threshold, lowest first."""

    def rank(score: Column, i: Column) -> Column:
        wanted = (score <= threshold) & is_score(score)
        if labels is not None:
            wanted = wanted & (F.get(labels, i) == NEGATIVE)
        return F.when(wanted, F.struct(score.alias("confidence"), i.alias("pos")))

    ranks = F.filter(F.transform(scores, rank), lambda r: r.isNotNull())
    return F.slice(F.array_sort(ranks), 1, k)


def with_response(rank: Column, responses: Column) -> Column:
    """Struct (pos, confidence, response) for a rank, NULL for none."""
    return F.when(
        rank.isNotNull(),
        F.struct(
            rank["pos"].alias("pos"), rank["confidence"].alias("confidence"),
            F.get(responses, rank["pos"]).alias("response"),
        ),
    )
