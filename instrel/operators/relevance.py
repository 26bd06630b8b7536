"""Second look at relevance: scoring inputs, verdicts, routing, kept passages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.constants import NEGATIVE, POSITIVE, SCORER_TEMPLATE
from instrel.functions.verdicts import relevance_verdict, routing_bucket

PAIR_KEYS = ["id", "choice_index", "pos"]
VALID = ("valid_positive", "valid_negative")

# A scorer turns a batch of texts into two columns of logits: true and false.
Scorer = Callable[[pd.Series], pd.DataFrame]


_SCORERS: dict[str, Scorer] = {}


def scorer_of_process(name: str, make_scorer: Callable[[], Scorer]) -> Scorer:
    """The scorer that this process has made under this name; making another drops it."""
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = make_scorer()
    return _SCORERS[name]


def combine_query(query: Column, instruction: Column) -> Column:
    return F.concat(F.coalesce(query, F.lit("")), F.lit(" "), F.coalesce(instruction, F.lit("")))


def _scorer_text(query: Column, passage: Column) -> Column:
    before, rest = SCORER_TEMPLATE.split("{query}")
    between, after = rest.split("{text}")
    return F.concat(F.lit(before), query, F.lit(between), passage, F.lit(after))


def relevance_pairs(candidates: DataFrame) -> DataFrame:
    """Two texts to score per candidate: about the query, and about query and instruction; a missing part is empty."""
    query = F.coalesce(F.col("query"), F.lit(""))
    passage = F.coalesce(F.col("passage"), F.lit(""))
    texts = F.array(
        F.struct(F.lit("query").alias("kind"), _scorer_text(query, passage).alias("text")),
        F.struct(
            F.lit("instruction").alias("kind"),
            _scorer_text(combine_query(query, F.col("instruction")), passage).alias("text"),
        ),
    )
    return candidates.select(*PAIR_KEYS, F.inline(texts))


def score_pairs(pairs: DataFrame, make_scorer: Callable[[], Scorer], budget: int | None = None) -> DataFrame:
    """Logits of every pair, in batches as of ``score_candidates``. ids may be of any type.

    ``make_scorer`` runs once in each worker process, whose later tasks find its scorer under ``name``.
    """
    wanted = pairs.select(*PAIR_KEYS, "kind", "text")
    return _scored(wanted, {"text": ("true_logit", "false_logit")}, make_scorer, budget or BUDGET)


def pair_logits(scored: DataFrame) -> DataFrame:
    """Scored pairs as one row per candidate: four logits."""

    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("kind") == kind, F.col(column)))

    return scored.groupBy(*PAIR_KEYS).agg(
        of("query", "true_logit").alias("q_true"),
        of("query", "false_logit").alias("q_false"),
        of("instruction", "true_logit").alias("i_true"),
        of("instruction", "false_logit").alias("i_false"),
    )


#: Characters of a batch that a scorer gets at once: its longest text times its number of texts.
BUDGET = 1 << 18
#: Bytes of rows whose texts are Python objects at once.
SLICE = 4 << 20


def packed_batches(lengths: np.ndarray, budget: int) -> Iterator[np.ndarray]:
    """Positions of texts in batches, longest first: a batch's longest length times its size is within the budget, or it is one text."""
    order = np.argsort(-lengths, kind="stable")
    start = 0
    while start < len(order):
        most = max(1, int(budget // max(1, lengths[order[start]])))
        yield order[start:start + most]
        start += most


def _slices(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes``, at least one row each."""
    for batch in batches:
        before = sum(column.nbytes for column in batch.columns)
        step = max(1, int(batch.num_rows * most_bytes / max(before, 1)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _scored(rows: DataFrame, texts: dict[str, tuple[str, str]], make_scorer: Callable[[], Scorer], budget: int) -> DataFrame:
    """The rows with two logits, named by ``texts``, in place of each of these columns.

    Only the texts of ``SLICE`` bytes of rows are Python objects at once; all other columns stay in Arrow.
    """
    name, keys = uuid.uuid4().hex, [c for c in rows.columns if c not in texts]
    named = [c for both in texts.values() for c in both]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of_process(name, make_scorer)
        for batch in _slices(batches, SLICE):
            both = pd.concat([batch.column(c).to_pandas() for c in texts], ignore_index=True)
            logits = np.empty((len(both), 2))
            for at in packed_batches(both.str.len().fillna(0).to_numpy(), budget):
                logits[at] = scorer(both.iloc[at].reset_index(drop=True)).iloc[:, :2].to_numpy(dtype=float)
            n = batch.num_rows
            found = [pa.array(logits[i * n:(i + 1) * n, j]) for i in range(len(texts)) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), *found], [*keys, *named])

    schema = rows.select(*keys).schema
    for column in named:
        schema = schema.add(column, "double")
    return rows.mapInArrow(score, schema)


def score_candidates(candidates: DataFrame, make_scorer: Callable[[], Scorer], budget: int = BUDGET) -> DataFrame:
    """The four logits of each candidate, in its own row: both its texts are made and scored where it is, without a shuffle.

    The texts of some rows are sorted by length and go to the scorer in batches of like lengths that hold ``budget``
    characters at most when padded to their longest, so that little is padded and memory is bounded. Keys may be of any type.
    """
    query, passage = F.coalesce(F.col("query"), F.lit("")), F.coalesce(F.col("passage"), F.lit(""))
    texts = candidates.select(
        *PAIR_KEYS, _scorer_text(query, passage).alias("query_text"),
        _scorer_text(combine_query(query, F.col("instruction")), passage).alias("instruction_text"))
    return _scored(texts, {"query_text": ("q_true", "q_false"), "instruction_text": ("i_true", "i_false")}, make_scorer, budget)


def verdicts(logits: DataFrame) -> DataFrame:
    """Both verdicts of each candidate."""
    return logits.select(
        *PAIR_KEYS,
        relevance_verdict(F.col("q_true"), F.col("q_false")).alias("q"),
        relevance_verdict(F.col("i_true"), F.col("i_false")).alias("i"),
    ).select(
        *PAIR_KEYS,
        F.col("q.is_relevant").alias("query_relevant"), F.col("q.confidence").alias("query_score"),
        F.col("i.is_relevant").alias("instruction_relevant"), F.col("i.confidence").alias("instruction_score"),
    )


def route_scored(
    candidates: DataFrame, make_scorer: Callable[[], Scorer], budget: int = BUDGET, keep_unlabelled: bool = False,
) -> DataFrame:
    """Candidates scored where they are: keys, label, both verdicts and the bucket. Nothing is joined or shuffled."""
    if not keep_unlabelled:
        candidates = candidates.where(F.col("label").isin(POSITIVE, NEGATIVE))
    # The label goes through the scorer with the key, which may hold any columns.
    keyed = candidates.withColumn("id", F.struct("id", "label"))
    judged = verdicts(score_candidates(keyed, make_scorer, budget)).select(
        F.col("id.id").alias("id"), "choice_index", "pos", F.col("id.label").alias("label"),
        "query_relevant", "query_score", "instruction_relevant", "instruction_score")
    return judged.withColumn("bucket", routing_bucket(F.col("label"), F.col("query_relevant"), F.col("instruction_relevant")))


def route_candidates(candidates: DataFrame, logits: DataFrame, keep_unlabelled: bool = False) -> DataFrame:
    """Candidates with both verdicts and the bucket they fall into.

    A candidate with any other label than the two is left out, before the join, unless
    ``keep_unlabelled`` is set. One without logits is ``unscored``. The join key names one candidate, so no key can be heavy.
    """
    if not keep_unlabelled:
        candidates = candidates.where(F.col("label").isin(POSITIVE, NEGATIVE))
    bucket = routing_bucket(F.col("label"), F.col("query_relevant"), F.col("instruction_relevant"))
    return candidates.join(verdicts(logits), PAIR_KEYS, "left").withColumn("bucket", bucket)


def filtered_passages(candidates: DataFrame, logits: DataFrame) -> DataFrame:
    """Flat table of the candidates that are kept.

    Both kinds that are kept are relevant to the query, so the other logits go
    before the join.
    """
    relevant = logits.where((F.col("q_true") > F.col("q_false")) & ~F.isnan("q_true"))
    return route_candidates(candidates, relevant).where(F.col("bucket").isin(*VALID)).select(
        F.col("id").alias("original_id"), "query", "instruction",
        F.col("item_id").alias("passage_id"), "title", "passage", "label",
        F.lit("kept").alias("filter_status"), "neg_type", "explanation", "confidence",
    )


def filter_summary(routed: DataFrame) -> DataFrame:
    """One row: passages kept and discarded, in total and per label, and those that had no logits."""
    counts = {
        name: F.count_if(F.col("bucket") == bucket)
        for name, bucket in (
            ("valid_positives", "valid_positive"), ("valid_negatives", "valid_negative"),
            ("discarded_positives", "discarded_positive"), ("discarded_negatives", "discarded_negative"),
            ("unscored", "unscored"),
        )
    }
    return routed.agg(
        F.count_if(F.col("bucket").isin(*VALID)).alias("passages_kept"),
        *[count.alias(name) for name, count in counts.items()],
    )
