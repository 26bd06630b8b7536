"""Prompt requests: one row per call that an outside batch service has to make."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.constants import LENGTHS, STYLES
from instrel.functions.templates import render
from instrel.functions.variants import uniform_choice

INSTRUCTION_STAGE = "instruction"
PASSAGE_STAGE = "passages"


def complete_inputs(qa: DataFrame) -> DataFrame:
    """Inputs that have both a question and an answer."""
    return qa.where(F.col("question").isNotNull() & F.col("answer").isNotNull())


def assign_variant(qa: DataFrame, salt: str = "") -> DataFrame:
    """Add the style and length asked for, the same ones in every run with the same salt."""
    return qa.withColumns(
        {
            "style": uniform_choice(F.col("id"), salt + "style", STYLES),
            "length": uniform_choice(F.col("id"), salt + "length", LENGTHS),
        }
    )


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def render_instruction_prompt(qa: DataFrame, template: str) -> DataFrame:
    """Add ``prompt``, which asks for an instruction; other texts come from ``chunk`` if it is there."""
    holes = {
        "Question": F.col("question"),
        "Response": F.col("answer"),
        "OtherDocs": _column_or_null(qa, "chunk"),
        "STYLE": F.col("style"),
        "LENGTH": F.col("length"),
    }
    return qa.withColumn("prompt", render(template, holes))


def render_passage_prompt(df: DataFrame, template: str) -> DataFrame:
    """Add ``prompt``, which asks for passages about a question and its instruction."""
    holes = {
        "Query": F.col("question"),
        "Instruction": F.col("instruction"),
        "SourceChunks": _column_or_null(df, "chunk"),
    }
    return df.withColumn("prompt", render(template, holes))


def request_id(stage: str) -> Column:
    """Stage and input id: one request per input and stage."""
    return F.concat_ws(":", F.lit(stage), F.col("id").cast("string"))


def build_requests(df: DataFrame, stage: str, system_prompt: str, model: str) -> DataFrame:
    """Request id, messages (user, then system) and JSON body for each prompt."""
    messages = F.array(
        F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")),
        F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")),
    )
    body = F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            F.col("messages"),
            F.struct(F.lit("json_object").alias("type")).alias("response_format"),
        )
    )
    return (
        df.withColumn("request_id", request_id(stage))
        .withColumn("messages", messages)
        .withColumn("body", body)
    )
