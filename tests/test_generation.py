import json

import pytest
from pyspark.sql import functions as F

from instrel.functions.templates import load_template, render, template_pieces
from instrel.operators import incremental, intake, reports, requests
from instrel.plans import flows

QA = "id bigint, question string, answer string"
COMPLETIONS = "request_id string, choice_index int, content string"


@pytest.fixture()
def qa(spark):
    return spark.createDataFrame(
        [(1, "Q1 {{Response}}", "A1"), (2, "Q2", "A2"), (3, None, "A3"), (4, "Q4", "A4"), (5, "Q5", "A5")], QA
    )


def test_values_that_look_like_holes_stay_text(spark, qa):
    row = qa.where("id = 1").select(
        render("{{ Question }}|{{Response}}|{{Nothing}}\n", {"Question": F.col("question"), "Response": F.col("answer")})
    ).first()
    assert row[0] == "Q1 {{Response}}|A1|"


def test_template_pieces():
    assert template_pieces("a{{b}}c\n\n") == [("text", "a"), ("hole", "b"), ("text", "c\n")]
    with pytest.raises(ValueError):
        template_pieces("{% if x %}")
    holes = {name for kind, name in template_pieces(load_template("instruction")) if kind == "hole"}
    assert holes == {"Question", "Response", "OtherDocs", "STYLE", "LENGTH"}


def test_variants_are_reproducible_and_spread(spark):
    inputs = spark.range(2000)
    first, second = (requests.assign_variant(inputs).orderBy("id").collect() for _ in range(2))
    assert first == second
    counts = requests.assign_variant(inputs).groupBy("style", "length").count().collect()
    assert len(counts) == 16 and min(r["count"] for r in counts) > 80
    assert requests.assign_variant(inputs, "x").orderBy("id").collect() != first


def test_requests_ask_user_then_system(spark, qa):
    built = flows.instruction_requests(qa, flows.Prompts(model="m"))
    assert built.count() == 4
    row = built.where("id = 2").first()
    body = json.loads(row["body"])
    assert row["request_id"] == "instruction:2" and body["model"] == "m"
    assert [m["role"] for m in body["messages"]] == ["user", "system"]
    assert body["messages"][0]["content"] == row["prompt"]


def completions(spark, *rows):
    return spark.createDataFrame(rows, COMPLETIONS)


def test_instruction_comes_from_the_first_choice(spark, qa):
    answers = completions(
        spark,
        ("instruction:1", 0, '{"instruction":"one","style":"persona"}'), ("instruction:1", 1, '{"instruction":"two"}'),
        ("instruction:2", 0, "{'instruction': 'x'}"), ("instruction:2", 1, '{"instruction":"two"}'),
        ("instruction:4", 0, '{"other":"x"}'), ("instruction:9", 0, '{"instruction":"orphan"}'),
    )
    asked = flows.with_request_id(requests.complete_inputs(qa), "instruction")
    taken = intake.intake_instruction(asked, answers).collect()
    assert [(r["id"], r["instruction"], r["echo_style"]) for r in taken] == [(1, "one", "persona")]
    rejects = {r["id"]: r["reason"] for r in intake.instruction_rejects(asked, answers).collect()}
    assert rejects == {"2": "bad_json", "4": "no_instruction", "5": "no_completion"}


GOOD = '{"examples":[{"label":"positive","confidence":0.9}]}'


@pytest.fixture()
def answered(spark, qa):
    asked = flows.with_request_id(qa, "passages")
    answers = completions(
        spark,
        ("passages:1", 0, GOOD), ("passages:1", 1, '{"examples":[{"id'),
        ("passages:2", 0, GOOD), ("passages:2", 1, '{"error":"COULD_NOT_GENERATE_N_NEGATIVES"}'), ("passages:2", 2, GOOD),
        ("passages:3", 0, GOOD), ("passages:3", 1, '{"examples":{}}'),
        ("passages:4", 0, "5"), ("passages:4", 1, GOOD + " and more"),
    )
    return asked, answers


def test_broken_envelope_costs_the_request_broken_json_the_choice(answered):
    kept = intake.intake_passages(*answered).collect()
    assert [(r["id"], r["choice_index"]) for r in kept] == [(1, 0)]
    rejects = {(r["id"], r["choice_index"]): r["reason"] for r in intake.passage_rejects(*answered).collect()}
    assert rejects == {
        ("1", 1): "bad_json", ("2", 0): "row_lost", ("2", 1): "error_envelope", ("2", 2): "row_lost",
        ("3", 0): "row_lost", ("3", 1): "no_examples", ("4", 0): "no_examples", ("4", 1): "bad_json",
        ("5", None): "no_completion",
    }


def test_broken_choice_can_be_skipped_alone(answered):
    kept = intake.intake_passages(*answered, on_bad="skip_choice").collect()
    assert sorted((r["id"], r["choice_index"]) for r in kept) == [(1, 0), (2, 0), (2, 2), (3, 0)]
    assert intake.passage_rejects(*answered, on_bad="skip_choice").count() + len(kept) == 10


def test_flow_accounts_for_every_input(spark, qa, answered):
    instructions = completions(
        spark, *[(f"instruction:{i}", 0, json.dumps({"instruction": f"i{i}"})) for i in (1, 2, 4)]
    )
    run = (qa, instructions, answered[1])
    packages, rejects = flows.generated_packages(*run), flows.generation_rejects(*run)
    assert [(r["id"], r["query"], r["instruction"]) for r in packages.collect()] == [(1, "Q1 {{Response}}", "i1")]
    audit = {r["outcome"]: r["inputs"] for r in reports.yield_audit(qa, packages, rejects).collect()}
    assert audit == {"packaged": 1, "error_envelope": 1, "missing_text": 1, "bad_json": 1, "no_completion": 1}


def test_limit_zero_and_none_mean_all(qa):
    assert incremental.limit_rows(qa, 0).count() == incremental.limit_rows(qa, None).count() == 5
    assert [r["id"] for r in incremental.limit_rows(qa, 2).collect()] == [1, 2]


def test_pending_repeats_nothing(spark, qa):
    done = qa.where("id < 4").select("id")
    assert [r["id"] for r in incremental.pending(qa, done.union(done)).orderBy("id").collect()] == [4, 5]
    assert incremental.pending(qa, qa).count() == 0


def test_run_metrics(spark, qa):
    packages = spark.createDataFrame([(1,), (1,), (4,)], "id bigint")
    assert tuple(incremental.run_metrics(qa, packages).first()) == (5, 5, 3, 3)
    assert tuple(incremental.run_metrics(qa, packages, 2).first()) == (5, 2, 2, 1)


def test_one_request_with_a_third_of_all_completions(spark):
    requests_, others, heavy = spark.range(201).selectExpr("id"), 200, 100
    asked = flows.with_request_id(requests_, "passages")
    rows = [(f"passages:{i}", 0, GOOD) for i in range(1, others + 1)]
    rows += [("passages:0", c, GOOD) for c in range(heavy)]
    kept = intake.intake_passages(asked, completions(spark, *rows))
    assert kept.count() == others + heavy and kept.where("id = 0").count() == heavy
    broken = completions(spark, *rows, ("passages:0", heavy, '{"examples":0}'))
    assert intake.intake_passages(asked, broken).count() == others
    reasons = intake.passage_rejects(asked, broken).groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in reasons} == {"row_lost": heavy, "no_examples": 1}


def test_skew_does_not_need_broadcast(spark, answered):
    """The same results with sort-merge joins, as for tables too large to broadcast."""
    expected = sorted(map(str, intake.passage_rejects(*answered).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = intake.passage_rejects(*answered)
        assert sorted(map(str, frame.collect())) == expected
        assert [(r["id"], r["choice_index"]) for r in intake.intake_passages(*answered).collect()] == [(1, 0)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_choice_delivered_twice_counts_once(spark):
    from instrel.operators import intake

    wanted = spark.createDataFrame([("passages:1", 1)], "request_id string, id int")
    good = '{"examples":[{"id":0}]}'
    completions = spark.createDataFrame([("passages:1", 0, good), ("passages:1", 0, good), ("passages:1", 1, good)], "request_id string, choice_index int, content string")
    assert sorted(r["choice_index"] for r in intake.intake_passages(wanted, completions).collect()) == [0, 1]
    assert [(r["choice_index"], r["reason"]) for r in intake.passage_rejects(wanted, completions).collect()] == [(0, "duplicate")]
