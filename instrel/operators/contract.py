"""Checks of packages and completions against the rules stated for them.

Each check adds counts or flags to its row; only the one with an outside table of
source chunks joins. ``violations`` counts flags over the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.constants import (
    ERROR_TOO_FEW_NEGATIVES, FAILURE_MODES, MIN_FAILURE_MODES, NEGATIVE, NEGATIVE_WORDS,
    NEGATIVES_COUNT, POSITIVE, POSITIVE_WORDS,
)
from instrel.functions.json_text import STRICT, json_object, json_value
from instrel.functions.nested import members
from instrel.functions.once import with_once
from instrel.functions.scores import is_score
from instrel.functions.words import containment, normalised, with_ngrams, word_count

KEYS = ("id", "choice_index")


def check_counts(packages: DataFrame, fewest: int = NEGATIVES_COUNT, most: int = NEGATIVES_COUNT) -> DataFrame:
    """Exactly one positive, and a number of negatives within bounds."""
    counted = packages.select(
        *KEYS,
        F.size(F.filter("responses.label", lambda label: label == POSITIVE)).alias("positives"),
        F.size(F.filter("responses.label", lambda label: label == NEGATIVE)).alias("negatives"),
    )
    return counted.withColumn(
        "ok", (F.col("positives") == 1) & F.col("negatives").between(fewest, most)
    )


def check_word_length(
    candidates: DataFrame,
    positive: tuple[int, int] = POSITIVE_WORDS,
    negative: tuple[int, int] = NEGATIVE_WORDS,
) -> DataFrame:
    """Words per passage, and whether they are within the bounds for its label."""
    words = F.col("words")
    return candidates.select(*KEYS, "pos", "label", word_count(F.col("passage")).alias("words")).withColumn(
        "ok",
        F.when(F.col("label") == POSITIVE, words.between(*positive))
        .when(F.col("label") == NEGATIVE, words.between(*negative)),
    )


def check_failure_modes(packages: DataFrame, at_least: int = MIN_FAILURE_MODES) -> DataFrame:
    """Distinct failure modes of the negatives, and how many are no known mode."""
    known = F.array(*[F.lit(mode) for mode in FAILURE_MODES])
    negatives = F.filter(
        members("responses", "label", "neg_type"), lambda r: (r["label"] == NEGATIVE) & r["neg_type"].isNotNull()
    )
    read = with_once(packages.select(*KEYS, "responses"), modes=F.array_distinct(negatives["neg_type"]))
    return read.select(
        *KEYS,
        F.size(F.array_intersect("modes", known)).alias("distinct_modes"),
        F.size(F.array_except("modes", known)).alias("unknown_modes"),
    ).withColumn("ok", (F.col("distinct_modes") >= at_least) & (F.col("unknown_modes") == 0))


def check_fields(packages: DataFrame) -> DataFrame:
    """Number of passages per package that break each field rule."""
    positive, negative = (lambda r: r["label"] == POSITIVE), (lambda r: r["label"] == NEGATIVE)
    rules = {
        "bad_confidence": lambda r: F.coalesce(
            ~is_score(r["confidence"]) | ~r["confidence"].between(0.0, 1.0), F.lit(True)
        ),
        "positive_with_neg_type": lambda r: positive(r) & r["neg_type"].isNotNull(),
        "positive_without_why": lambda r: positive(r) & r["why_relevant"].isNull(),
        "negative_without_neg_type": lambda r: negative(r) & r["neg_type"].isNull(),
        "negative_with_why": lambda r: negative(r) & r["why_relevant"].isNotNull(),
        "negative_without_explanation": lambda r: negative(r) & r["explanation"].isNull(),
    }
    fields = members("responses", "label", "neg_type", "explanation", "why_relevant", "confidence")
    read = with_once(packages.select(*KEYS, "responses"), r=fields)
    return read.select(*KEYS, *[F.size(F.filter("r", rule)).alias(name) for name, rule in rules.items()])


def check_evidence(packages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Evidence ids that name no source chunk of their package.

    The join key is package and chunk id; equal ids cited many times are
    counted before the shuffle.
    """
    cited = packages.select(*KEYS, F.explode("responses.evidence").alias("evidence")).select(
        *KEYS, F.explode("evidence").alias("chunk_id")
    )
    cited = cited.groupBy(*KEYS, "chunk_id").agg(F.count(F.lit(1)).alias("citations"))
    return cited.join(chunks.select("id", "chunk_id"), ["id", "chunk_id"], "left_anti")


def check_error_envelope(completions: DataFrame) -> DataFrame:
    """Completions that report an error instead of passages, with what they report."""
    read = with_once(completions, fields=json_object(F.col("content")))
    return (
        read
        .where(F.col("fields")["error"].isNotNull())
        .select(
            "request_id", "choice_index",
            F.col("fields")["error"].alias("error"),
            F.col("fields")["reason"].alias("reason"),
            F.col("fields")["produced_negatives"].try_cast("int").alias("produced_negatives"),
            (F.col("fields")["error"] == ERROR_TOO_FEW_NEGATIVES).alias("known_error"),
        )
    )


def _bounded(name: str) -> Column:
    """Normalised text between blanks, so that it is found as whole words only."""
    return F.concat(F.lit(" "), F.col(name), F.lit(" "))


def check_answer_leak(packages: DataFrame, ngram: int = 3, threshold: float = 0.5) -> DataFrame:
    """Does the instruction give the answer: word for word, or most of its word n-grams?"""
    texts = with_once(
        packages.select(*KEYS, "instruction", "og_positive"),
        said=normalised(F.col("instruction")), answer=normalised(F.col("og_positive")),
    )
    grams = with_ngrams(with_ngrams(texts, "answer", "answer_grams", ngram), "said", "said_grams", ngram)
    return grams.select(
        *KEYS,
        ((F.col("answer") != "") & F.contains(_bounded("said"), _bounded("answer"))).alias("verbatim"),
        containment(F.col("answer_grams"), F.col("said_grams")).alias("overlap"),
    ).withColumn("leaks", F.col("verbatim") | (F.col("overlap") >= threshold))


def check_variant_echo(instructions: DataFrame) -> DataFrame:
    """Style and length named in the completion against those asked for; NULL if not named."""
    return instructions.select(
        "id",
        "style", "echo_style", (F.col("echo_style") == F.col("style")).alias("style_ok"),
        "length", "echo_length", (F.col("echo_length") == F.col("length")).alias("length_ok"),
    )


def check_doc_partition(completions: DataFrame) -> DataFrame:
    """Relevant and other document ids of a completion: two lists, disjoint, the first not empty."""
    docs = F.from_json(
        json_value(F.col("content")), "struct<relevant_docs: array<int>, non_relevant_docs: array<int>>", STRICT
    )
    read = with_once(completions, d=docs)
    relevant, other = F.col("d.relevant_docs"), F.col("d.non_relevant_docs")
    return read.select(
        "request_id", "choice_index",
        F.coalesce(relevant.isNotNull() & other.isNotNull(), F.lit(False)).alias("has_lists"),
        F.coalesce(F.size(relevant) > 0, F.lit(False)).alias("has_relevant"),
        F.coalesce(~F.arrays_overlap(relevant, other), F.lit(False)).alias("disjoint"),
    )


def violations(checked: DataFrame, *rules: str) -> DataFrame:
    """One row per rule: rows for which the flag is false, and rows it applies to."""
    counts = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                F.count_if(~F.col(rule)).alias("violations"),
                F.count(F.col(rule)).alias("checked"),
            )
            for rule in rules
        ]
    )
    return checked.agg(counts.alias("c")).select(F.inline("c"))
