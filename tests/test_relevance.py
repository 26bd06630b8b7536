import pandas as pd
from conftest import package_frame
from pyspark.sql import functions as F

from instrel.operators import parsing, relevance
from instrel.plans import catalog, flows

LOGITS = "id bigint, choice_index int, pos int, q_true double, q_false double, i_true double, i_false double"


def test_tie_is_not_relevant_and_half_sure(spark):
    logits = spark.createDataFrame([(0, 0, 0, 1.0, 1.0, 2.0, 1.0)], LOGITS)
    row = relevance.verdicts(logits).first()
    assert row["query_relevant"] is False and row["query_score"] == 0.5
    assert row["instruction_relevant"] is True and abs(row["instruction_score"] - 0.731059) < 1e-6


def test_extreme_logits_stay_finite(spark):
    logits = spark.createDataFrame([(0, 0, 0, -900.0, 900.0, 900.0, -900.0)], LOGITS)
    row = relevance.verdicts(logits).first()
    assert (row["query_score"], row["instruction_score"]) == (1.0, 1.0)


def test_buckets_partition_the_candidates(spark):
    labels = ["positive", "negative", "Positive", None]
    packages = package_frame(spark, *[[(label, 0.5) for label in labels]] * 4)
    yes, no = (1.0, 0.0), (0.0, 1.0)
    verdicts = [(yes, yes), (yes, no), (no, yes), (no, no)]
    logits = spark.createDataFrame(
        [(n, 0, pos, *q, *i) for n, (q, i) in enumerate(verdicts) for pos in range(4)], LOGITS
    )
    candidates = parsing.explode_candidates(packages, "query", "instruction")
    routed = relevance.route_candidates(candidates, logits, keep_unlabelled=True).collect()
    assert len(routed) == 16
    buckets = {(r["id"], r["pos"]): r["bucket"] for r in routed}
    assert [buckets[n, 0] for n in range(4)] == ["valid_positive"] + ["discarded_positive"] * 3
    assert [buckets[n, 1] for n in range(4)] == ["discarded_negative", "valid_negative"] + ["discarded_negative"] * 2
    assert {buckets[n, pos] for n in range(4) for pos in (2, 3)} == {"unlabelled"}
    kept, summary = flows.filter_by_relevance(packages, logits)
    assert {(r["original_id"], r["label"]) for r in kept.collect()} == {(0, "positive"), (1, "negative")}
    assert tuple(summary.first()) == (2, 1, 1, 3, 3, 0)


def test_nan_and_missing_logits(spark):
    packages = package_frame(spark, [("positive", 0.5), ("negative", 0.5), ("positive", 0.5)])
    nan = float("nan")
    logits = spark.createDataFrame([(0, 0, 0, nan, 0.0, 1.0, 0.0), (0, 0, 1, 1.0, 0.0, 0.0, nan)], LOGITS)
    candidates = parsing.explode_candidates(packages, "query", "instruction")
    routed = relevance.route_candidates(candidates, logits)
    assert {r["pos"]: r["bucket"] for r in routed.collect()} == {0: "discarded_positive", 1: "valid_negative", 2: "unscored"}
    assert relevance.filter_summary(routed).first()["unscored"] == 1
    assert [r["passage_id"] for r in relevance.filtered_passages(candidates, logits).collect()] == [1]


def test_text_ids_are_scored(spark):
    frame = spark.createDataFrame([("a1", 0, 0, "q", "i", "p")], "id string, choice_index int, pos int, query string, instruction string, passage string")
    scored = relevance.score_pairs(relevance.relevance_pairs(frame), catalog.word_scorer())
    assert {r["id"] for r in relevance.pair_logits(scored).collect()} == {"a1"}


def test_two_texts_per_candidate(spark):
    candidates = parsing.explode_candidates(package_frame(spark, [("positive", 0.5)]), "query", "instruction")
    texts = {r["kind"]: r["text"] for r in relevance.relevance_pairs(candidates).collect()}
    assert texts == {"query": "Is the passage about q0?: p0", "instruction": "Is the passage about q0 i?: p0"}


def test_scorer_is_made_once_per_task(spark):
    def make():
        made = []

        def score(texts):
            made.append(1)
            return pd.DataFrame({"t": texts.str.len().astype(float), "f": float(len(made) > 0)})

        return score

    candidates = parsing.explode_candidates(package_frame(spark, [("positive", 0.5)] * 3), "query", "instruction")
    scored = relevance.score_pairs(relevance.relevance_pairs(candidates), make)
    logits = relevance.pair_logits(scored)
    assert logits.count() == 3
    assert logits.where(F.col("q_true") < F.col("i_true")).count() == 3
