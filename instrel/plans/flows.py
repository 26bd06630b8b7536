"""The three whole flows: generation, analysis and relevance filtering.

Calls to a model are outside: a flow hands out a request table and takes a
completion (or logit) table back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from instrel.functions.templates import load_template
from instrel.session import shared_dir
from instrel.operators import distributions, intake, parsing, relevance, requests, selecting

INSTRUCTION_SYSTEM_PROMPT = (
    "You narrow what counts as relevant to a question. Reply with one JSON object with the keys "
    "instruction, length and style, and keep the answer out of the instruction."
)
PASSAGE_SYSTEM_PROMPT = (
    "You write one passage that meets an instruction and five that fail it, as one JSON object."
)


@dataclass(frozen=True)
class Prompts:
    """Templates, system prompts and model name of a generation run."""

    model: str
    instruction_template: str = load_template("instruction")
    passage_template: str = load_template("passages")
    instruction_system: str = INSTRUCTION_SYSTEM_PROMPT
    passage_system: str = PASSAGE_SYSTEM_PROMPT
    salt: str = ""


def instruction_requests(qa: DataFrame, prompts: Prompts) -> DataFrame:
    """Complete inputs with their variant and the request for an instruction."""
    varied = requests.assign_variant(requests.complete_inputs(qa), prompts.salt)
    rendered = requests.render_instruction_prompt(varied, prompts.instruction_template)
    return requests.build_requests(
        rendered, requests.INSTRUCTION_STAGE, prompts.instruction_system, prompts.model
    )


def passage_requests(instructed: DataFrame, prompts: Prompts) -> DataFrame:
    """Inputs that have an instruction, with the request for passages."""
    rendered = requests.render_passage_prompt(instructed, prompts.passage_template)
    return requests.build_requests(rendered, requests.PASSAGE_STAGE, prompts.passage_system, prompts.model)


def with_request_id(df: DataFrame, stage: str) -> DataFrame:
    return df.withColumn("request_id", requests.request_id(stage))


def _input_rejects(qa: DataFrame) -> DataFrame:
    missing = qa.where(F.col("question").isNull() | F.col("answer").isNull())
    return missing.select(
        F.lit(requests.INSTRUCTION_STAGE).alias("stage"), F.col("id").cast("string").alias("id"),
        F.lit(None).cast("int").alias("choice_index"), F.lit("missing_text").alias("reason"),
        F.lit(None).cast("string").alias("raw"),
    )


def _requested(
    qa: DataFrame, instruction_completions: DataFrame, salt: str
) -> tuple[DataFrame, DataFrame]:
    """Instruction requests, and the passage requests of those that got an instruction."""
    complete = requests.assign_variant(requests.complete_inputs(qa), salt)
    first = with_request_id(complete, requests.INSTRUCTION_STAGE)
    instructed = intake.intake_instruction(first, instruction_completions).drop("request_id")
    return first, with_request_id(instructed, requests.PASSAGE_STAGE)


def generated_packages(
    qa: DataFrame, instruction_completions: DataFrame, passage_completions: DataFrame, salt: str = ""
) -> DataFrame:
    """Packages as text, from inputs and both completion tables."""
    _, second = _requested(qa, instruction_completions, salt)
    return intake.assemble_packages(intake.intake_passages(second, passage_completions))


def generation_rejects(
    qa: DataFrame, instruction_completions: DataFrame, passage_completions: DataFrame, salt: str = ""
) -> DataFrame:
    """Everything of the same run that is in no package. Only ids are joined."""
    first, second = _requested(qa, instruction_completions, salt)
    return (
        _input_rejects(qa)
        .unionByName(intake.instruction_rejects(first, instruction_completions))
        .unionByName(intake.passage_rejects(second, passage_completions))
    )


def analyse(package_text: DataFrame) -> dict[str, DataFrame]:
    """Reports on the packages of a text table, each lazy. The texts are parsed once, into the shared folder."""
    parsed = parsing.parse_items(package_text)
    path = shared_dir(package_text.sparkSession, "parsed")
    parsed.write.option("compression", "zstd").parquet(path)
    parsed = package_text.sparkSession.read.schema(parsed.schema).parquet(path)
    packages = parsing.to_responses(parsing.strict_packages(parsed))
    candidates = parsing.explode_candidates(packages, fields=("label", "confidence"))
    return {
        "label_stats": distributions.label_stats(candidates),
        "responses_per_query": distributions.responses_per_query(packages),
        "query_threshold_distribution": distributions.query_threshold_distribution(packages),
        "selected": selecting.select_responses(packages),
        "rejects": parsing.parse_rejects(parsed),
    }


def filter_by_relevance(packages: DataFrame, logits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept passages and the summary of what was kept and discarded."""
    candidates = parsing.explode_candidates(packages, "query", "instruction")
    narrow = parsing.explode_candidates(packages, fields=("label",))
    return (
        relevance.filtered_passages(candidates, logits),
        relevance.filter_summary(relevance.route_candidates(narrow, logits)),
    )
