"""Statistics by increments, batches that count once, streams that ask once, and intake without moving texts."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from conftest import package_frame, score_frame
from pyspark.sql import functions as F

from instrel.operators import distributions, intake, relevance, summaries
from instrel.plans import catalog
from instrel.plans.flows import Prompts
from instrel.sources import batches, tables
from instrel.streaming import ingest

QA = "id bigint, question string, answer string, chunk string"


def close(a, b):
    return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_merged_states_equal_the_whole(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [(("positive", "negative", None)[i % 3], float(x)) for i, x in enumerate(np.concatenate([rng.normal(1000, 2, 300), rng.exponential(1, 300)]))]
    rows += [("positive", None), ("negative", float("nan")), ("negative", float("inf"))]
    frame = spark.createDataFrame([(l, x, i % parts) for i, (l, x) in enumerate(rows)], "label string, confidence double, part int")
    states = [summaries.summarise(frame.where(F.col("part") == p)) for p in range(parts)]
    union = states[0]
    for state in states[1:]:
        union = union.unionByName(state)
    got = {r.label_class: r for r in summaries.describe_state(union).collect()}
    want = {r.label_class: r for r in distributions.label_stats(frame).collect()}
    assert got.keys() == want.keys() == {"overall", "positive", "negative"}
    for name, row in want.items():
        for column in ("count", "mean", "std", "min", "max", "variance", "percentage"):
            assert close(got[name][column], row[column]), (name, column)
        for column in ("skewness", "kurtosis"):
            assert abs(got[name][column] - row[column]) < 1e-6


def test_few_equal_and_no_scores(spark):
    empty = summaries.describe_state(summaries.summarise(score_frame(spark, [])))
    assert empty.count() == 0
    same = summaries.summarise(score_frame(spark, [0.1] * 5)).unionByName(summaries.summarise(score_frame(spark, [0.1])))
    row = summaries.describe_state(same).where("label_class = 'positive'").first()
    assert (row["count"], row["skewness"], row["kurtosis"], row["median"]) == (6, 0.0, 0.0, 0.1)


def test_sketched_quantiles_keep_their_rank_error(spark):
    rng = np.random.default_rng(4)
    scores = np.sort(np.concatenate([rng.random(30000), rng.normal(0.5, 0.01, 10000)]))
    frame = spark.createDataFrame([("positive", float(x)) for x in rng.permutation(scores)], "label string, confidence double").repartition(8)
    states = None
    for part in range(4):
        one = summaries.summarise(frame.where(F.pmod(F.hash("confidence"), F.lit(4)) == part))
        states = one if states is None else states.unionByName(one)
    row = summaries.describe_state(states).where("label_class = 'overall'").first()
    for p, column in ((0.25, "q25"), (0.5, "median"), (0.75, "q75")):
        assert abs(np.searchsorted(scores, row[column]) / len(scores) - p) <= summaries.RANK_ERROR
    box = summaries.box_by_sketch(states, frame).first()
    low, high = box.q1 - 1.5 * (box.q3 - box.q1), box.q3 + 1.5 * (box.q3 - box.q1)
    inside = scores[(scores >= low) & (scores <= high)]
    assert box["count"] == len(scores) and box.outliers == len(scores) - len(inside)
    assert (box.whisker_low, box.whisker_high) == (inside[0], inside[-1])


def test_a_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    packages = package_frame(spark, [("positive", 0.5)], [])
    assert batches.manifest(spark, path).count() == 0
    assert batches.append_batch(packages, path, "a")["rows"] == 2
    assert batches.append_batch(packages, path, "a")["rows"] == 0
    assert batches.read_batches(spark, path).count() == 2
    assert batches.append_batch(packages, path, "b-1.x")["rows"] == 2
    read = batches.read_batches(spark, path)
    assert read.count() == 4 and read.drop("batch_id").dtypes == packages.dtypes
    with pytest.raises(ValueError):
        batches.append_batch(packages, path, "a/b")


def test_a_batch_that_was_cut_off_is_not_read_and_written_over(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    batches.append_batch(rows, path, "whole")
    rows.union(rows).write.parquet(f"{path}/rows/batch_id=cut")
    assert batches.read_batches(spark, path).count() == 2
    batches.append_batch(rows, path, "cut")
    assert batches.read_batches(spark, path).count() == 4
    with pytest.raises(ValueError):
        batches.read_batches(spark, str(tmp_path / "none"))
    assert batches.read_batches(spark, str(tmp_path / "none"), "id long").count() == 0


def add_files(spark, folder, *ids):
    for i in ids:
        spark.createDataFrame([(i, f"q{i}", f"a{i}" if i else None, None)], QA).coalesce(1).write.mode("append").parquet(f"{folder}/qa")


def run_once(spark, folder, **options):
    return ingest.run_requests_once(spark, f"{folder}/qa", f"{folder}/out", f"{folder}/progress", Prompts(model="m"), **options)["rows"]


def asked(spark, folder):
    return sorted(r.id for r in batches.read_batches(spark, f"{folder}/out").collect())


def test_an_id_of_several_files_is_asked_once(spark, tmp_path):
    folder = str(tmp_path)
    add_files(spark, folder, 0, 1, 2, 1)
    assert run_once(spark, folder, max_files=1) == 2  # input 0 has no answer
    assert run_once(spark, folder) == 0
    add_files(spark, folder, 2, 3, 3)
    assert run_once(spark, folder) == 1
    assert asked(spark, folder) == [1, 2, 3]


def test_a_crash_between_write_and_commit_repeats_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    add_files(spark, folder, 1, 2)
    append = ingest.append_batch

    def failing(*args):
        append(*args)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(ingest, "append_batch", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run_once(spark, folder)
    monkeypatch.setattr(ingest, "append_batch", append)
    assert asked(spark, folder) == [1, 2]
    assert run_once(spark, folder) == 0
    add_files(spark, folder, 2, 4)
    assert run_once(spark, folder) == 1
    assert asked(spark, folder) == [1, 2, 4]


def test_rows_of_more_batches_than_a_query_remembers(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    spark.createDataFrame([(i, f"q{i}", "a", None) for i in range(1, 121)], QA).repartition(120, "id").write.option(
        "maxRecordsPerFile", 1).parquet(f"{folder}/qa")
    monkeypatch.setattr(ingest, "read_requests", None)  # nothing that was written is read
    run = lambda: ingest.run_requests(spark, f"{folder}/qa", f"{folder}/out", f"{folder}/progress", Prompts(model="m"), max_files=1)["rows"]
    assert run() == 120
    assert run() == 0


def completions(spark, rows):
    return spark.createDataFrame(rows, "request_id string, choice_index int, content string")


def test_copies_are_numbered(spark):
    rng = random.Random(3)
    rows = [(f"p:{i}", c, f"text {i} {c}") for i in range(60) for c in range(2)]
    rows += [(f"p:{i}", 0, f"again {i}") for i in range(0, 60, 7)] + [("p:3", 1, "text 3 1")] * 3 + [(None, 0, "x"), (None, 0, "y"), ("p:1", None, None)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "request_id string, choice_index int, content string")
    got = sorted(((r.request_id, r.choice_index, r.content, r["copy"]) for r in intake._numbered(frame).collect()), key=str)
    groups = {}
    for request, choice, content in rows:
        groups.setdefault((request, choice), []).append(content)
    want = []
    for key, contents in groups.items():
        first = min((c for c in contents if c is not None), default=None)
        want += [(*key, first if n == 1 else None, n) for n in range(1, len(contents) + 1)]
    assert got == sorted(want, key=str)


def test_scoring_in_place_equals_scoring_pairs(spark, sf):
    from instrel.plans import derived

    candidates = derived.candidates(spark, sf)
    pairs = relevance.pair_logits(relevance.score_pairs(relevance.relevance_pairs(candidates), catalog.word_scorer()))
    wide = relevance.score_candidates(candidates, catalog.word_scorer(), budget=2000)
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, pairs.select(wide.columns).collect()))
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString().split("MapInPandas")[0]
    plan = relevance.route_scored(candidates, catalog.word_scorer())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInPandas")[0] and "Join" not in plan.split("MapInPandas")[0]


def test_batches_of_a_scorer_are_bounded_and_of_like_lengths():
    rng = np.random.default_rng(2)
    lengths = rng.integers(0, 3000, 500)
    lengths[7] = 90_000
    batches_ = list(relevance.packed_batches(lengths, 20_000))
    assert sorted(np.concatenate(batches_).tolist()) == list(range(500))
    for at in batches_:
        assert len(at) == 1 or lengths[at].max() * len(at) <= 20_000
    assert [lengths[at].max() for at in batches_] == sorted((lengths[at].max() for at in batches_), reverse=True)
    assert list(relevance.packed_batches(np.zeros(0, int), 5)) == []


def test_texts_of_package_rows_are_shuffled_once(spark, tmp_path):
    rows = [(None, "q", "p", "i", "r")] * 2 + [(None, "q", "p", "i", "s"), ("1", "q", None, "i", "r"), ("1", None, "p", "i", "r"), ("2", "q", "p", "i", "r")]
    spark.createDataFrame(rows, "ID string, Query string, OgPositive string, Instruction string, Response string").write.parquet(str(tmp_path / "t"))
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = tables.package_rows(spark.read.parquet(str(tmp_path / "t")))
        got = sorted(((r.id, r.choice_index, r.response) for r in numbered.collect()), key=str)
        planned = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert [r[:2] for r in got] == [("1", 0), ("1", 1), ("2", 0), (None, 0), (None, 1), (None, 2)]
    assert sorted(r[2] for r in got if r[0] is None) == ["r", "r", "s"]
    # Between the scan and the end, a row of texts meets one exchange: that of its copies.
    depth, line = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789")), planned.splitlines()
    joins = [i for i, x in enumerate(line) if "SortMergeJoin [_key" in x]
    assert len(joins) == 1, planned
    left = [x for x in line[joins[0] + 1:]]
    left = left[:next(i for i, x in enumerate(left) if i and depth(x) <= depth(left[0]))]
    assert sum("Exchange hashpartitioning" in x for x in left) == 1, planned


def test_stream_query_writes_and_reads_its_files_by_many_tasks(spark, tmp_path, monkeypatch):
    rows = [(i % 90, f"text {i}", "en", "s", 1) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.repartition(6).write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    monkeypatch.setattr(catalog, "shared_dir", lambda spark, name: str(tmp_path / name))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        got = sorted(r.id for r in catalog.stream_requests_once(spark, str(tmp_path / "sf")).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == [i for i in range(90) if i % 50 != 49]
    assert len(list((tmp_path / "stream-once" / "qa").glob("*.parquet"))) > 4
    assert batches.manifest(spark, str(tmp_path / "stream-once" / "requests")).count() == 2  # a batch for each copy


def test_few_texts_are_objects_at_once(spark):
    """A scorer gets batches within the budget from both entrances, and texts become Python objects by slices of rows."""
    seen = spark.sparkContext.accumulator(0)
    budget = 1000

    def make():
        def score(texts):
            if len(texts) > 1 and texts.str.len().max() * len(texts) > budget:
                seen.add(1)
            return pd.DataFrame({"t": texts.str.len() * 1.0, "f": texts.str.len() * 0.0})

        return score

    pairs = spark.range(3000).selectExpr("cast(id as string) as id", "0 as choice_index", "1 as pos", "'query' as kind", "repeat('x', cast(id % 50 as int)) as text")
    got = {r.id: r.true_logit for r in relevance.score_pairs(pairs, make, budget).collect()}
    assert got == {str(i): float(i % 50) for i in range(3000)} and seen.value == 0
    whole = pa.record_batch({"id": pa.array(range(5000)), "text": pa.array(["y" * 100] * 5000)})
    parts = list(relevance._slices(iter([whole]), 50_000))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))
    assert max(p.num_rows for p in parts) < 600
