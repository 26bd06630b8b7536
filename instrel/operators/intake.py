"""Completions in: instructions and passage packages out, failures as rejects.

Requests have one row per ``request_id``; a request may have any number of
completions. Rules that hold for a whole request come from a pre-aggregated
list of broken ids, so no request's completions have to meet in one task, and the
joins are of kinds whose completion side may be split where one request has very
many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.functions.json_text import is_json_list, json_object, json_value
from instrel.functions.once import with_once
from instrel.operators.requests import INSTRUCTION_STAGE, PASSAGE_STAGE
from instrel.session import shared_dir


def _rejects(df: DataFrame, stage: str, reason: Column, raw: Column) -> DataFrame:
    return df.select(
        F.lit(stage).alias("stage"),
        F.col("id").cast("string").alias("id"),
        F.col("choice_index"),
        reason.alias("reason"),
        raw.alias("raw"),
    )


def _not_json() -> Column:
    """Only a text that is no JSON object is looked at again: JSON of another kind, or none?"""
    return F.col("fields").isNull() & F.when(F.col("fields").isNull(), json_value(F.col("content"))).isNull()


def _numbered(completions: DataFrame) -> DataFrame:
    """One row of ``copy`` 1 for each choice, with the first of its contents, and a row 2, 3, .. without content for each

    time that it was delivered again. Copies are counted before the shuffle.
    """
    once = completions.groupBy("request_id", "choice_index").agg(F.min("content").alias("content"), F.count(F.lit(1)).alias("copies"))
    return once.select("request_id", "choice_index", "content", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")).withColumn(
        "content", F.when(F.col("copy") == 1, F.col("content")))


def _read_instruction(completions: DataFrame) -> DataFrame:
    """First choice only: its fields and, where it cannot be used, the reason. Takes a table so read as it is."""
    if "reason" in completions.columns:
        return completions
    first = _numbered(completions.where(F.col("choice_index") == 0))
    read = with_once(first, fields=json_object(F.col("content")))
    reason = F.when(F.col("copy") > 1, "duplicate").when(_not_json(), "bad_json").when(
        F.col("fields").isNull() | F.col("fields")["instruction"].isNull(), "no_instruction"
    )
    return read.select(
        "request_id", "choice_index", "content",
        F.col("fields")["instruction"].alias("instruction"),
        F.col("fields")["style"].alias("echo_style"),
        F.col("fields")["length"].alias("echo_length"),
        reason.alias("reason"),
    )


def _silent(requests: DataFrame, completions: DataFrame, stage: str) -> DataFrame:
    """Rejects for requests that got no completion. Reads ids only."""
    unanswered = requests.join(completions.select("request_id").distinct(), "request_id", "left_anti")
    return _rejects(
        unanswered.withColumn("choice_index", F.lit(None).cast("int")), stage,
        F.lit("no_completion"), F.lit(None).cast("string"),
    )


def classified(completions: DataFrame, stage: str) -> DataFrame:
    """Completions read once and stored: each with its reason, and its text only where it is a reject.

    Intake, rejects and audit of one run take this table in place of the completions and parse nothing.
    """
    read = _read_instruction(completions) if stage == INSTRUCTION_STAGE else read_passage_choices(completions)
    path = shared_dir(completions.sparkSession, f"classified-{stage}")
    read.withColumn("content", F.when(F.col("reason").isNotNull(), F.col("content"))).write.parquet(path)
    return completions.sparkSession.read.schema(read.schema).parquet(path)


def _answers(requests: DataFrame, good: DataFrame, stage: str) -> DataFrame:
    """Requests joined with their completions on ``id``, which the completion's request id spells.

    Both stages of a run are so joined on one key, and the inputs' texts are dealt out once.
    """
    kind = requests.schema["id"].dataType
    start = len(stage) + 2
    named = F.when(F.startswith("request_id", F.lit(f"{stage}:")), F.expr(f"substring(request_id, {start})"))
    return requests.join(good.withColumn("id", named.try_cast(kind)).drop("request_id"), "id")


def intake_instruction(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """Requests with the instruction of their first choice; unusable ones are left out."""
    good = _read_instruction(completions).where(F.col("reason").isNull())
    return _answers(requests, good.drop("choice_index", "content", "reason"), INSTRUCTION_STAGE)


def instruction_rejects(requests: DataFrame, completions: DataFrame) -> DataFrame:
    """First choices without a usable instruction, and requests without a first choice."""
    wanted = requests.select("request_id", "id")
    bad = wanted.join(_read_instruction(completions).where(F.col("reason").isNotNull()), "request_id")
    silent = _silent(wanted, completions.where(F.col("choice_index") == 0), INSTRUCTION_STAGE)
    return _rejects(bad, INSTRUCTION_STAGE, F.col("reason"), F.col("content")).unionByName(silent)


def read_passage_choices(completions: DataFrame) -> DataFrame:
    """Every choice with its list text (``examples``) and ``reason``, NULL for a usable one. Takes a table so read as it is."""
    if "reason" in completions.columns:
        return completions
    read = with_once(_numbered(completions), fields=json_object(F.col("content")))
    examples = F.col("fields")["examples"]
    reason = (
        F.when(F.col("copy") > 1, "duplicate").when(_not_json(), "bad_json")
        .when(F.col("fields")["error"].isNotNull() & ~F.coalesce(is_json_list(examples), F.lit(False)),
              "error_envelope")
        .when(~F.coalesce(is_json_list(examples), F.lit(False)), "no_examples")
    )
    return read.select("request_id", "choice_index", "content", examples.alias("examples"),
                       reason.alias("reason"))


def broken_requests(choices: DataFrame) -> DataFrame:
    """Ids of requests one of whose choices is JSON without a list of passages."""
    return (
        choices.where(F.col("reason").isin("error_envelope", "no_examples"))
        .select("request_id").distinct()
    )


def intake_passages(
    requests: DataFrame, completions: DataFrame, on_bad: str = "lose_row"
) -> DataFrame:
    """One row per usable choice.

    A choice that is not JSON is skipped. A choice that is JSON without a list of
    passages costs the whole request, good choices included; with
    ``on_bad="skip_choice"`` it only costs that choice.
    """
    choices = read_passage_choices(completions)
    good = choices.where(F.col("reason").isNull()).drop("reason", "content")
    if on_bad == "lose_row":
        good = good.join(broken_requests(choices), "request_id", "left_anti")
    elif on_bad != "skip_choice":
        raise ValueError("on_bad is lose_row or skip_choice")
    return _answers(requests, good, PASSAGE_STAGE)


def passage_rejects(
    requests: DataFrame, completions: DataFrame, on_bad: str = "lose_row"
) -> DataFrame:
    """Choices not taken in, and requests without any completion."""
    choices = read_passage_choices(completions)
    if on_bad == "lose_row":
        broken = broken_requests(choices).withColumn("broken", F.lit(True))
        lost = F.when(F.col("broken"), "row_lost")
        choices = choices.join(broken, "request_id", "left").withColumn("reason", F.coalesce("reason", lost))
    wanted = requests.select("request_id", "id")
    bad = wanted.join(choices.where(F.col("reason").isNotNull()), "request_id")
    return _rejects(bad, PASSAGE_STAGE, F.col("reason"), F.col("content")).unionByName(
        _silent(wanted, completions, PASSAGE_STAGE)
    )


def assemble_packages(taken: DataFrame) -> DataFrame:
    """Package text rows from passage requests taken in, one per usable choice.

    The requests carried their input's texts through the intake, so that no
    further join is needed.
    """
    return taken.select(
        "id", "choice_index",
        F.col("question").alias("query"),
        F.col("answer").alias("og_positive"),
        "instruction", "style", "length",
        F.col("examples").alias("response"),
    )
