"""Registered queries: (spark, folder of the given tables) -> DataFrame.

Each runs an operator over whole tables and flattens its result to plain columns.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from instrel.constants import ERROR_TOO_FEW_NEGATIVES
from instrel.functions.scores import label_class
from instrel.operators import (
    contract, distributions, incremental, intake, parsing, relevance, reports, requests, selecting, summaries,
)
from instrel.plans import derived, flows
from instrel.session import shared_dir
from instrel.sources import batches, tables
from instrel.streaming import ingest

PROMPTS = flows.Prompts(model="generator")
SCORED = ("id", "label", "confidence")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its function's name, or under one given as ``named``."""
    _QUERIES[build.__name__] = build
    return build


def named(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _QUERIES[name] = build
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *exact: str) -> DataFrame:
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" and c not in exact else F.col(c) for c, t in df.dtypes]
    )


# Inputs and incremental runs


@query
def limit_rows(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.limit_rows(derived.conversation_qa(spark, sf), 20).select("id", "question", "answer")


@query
def pending_rows(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.pending(derived.qa(spark, sf), derived.done(spark, sf)).select("id", "question", "answer")


@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    written = derived.packages(spark, sf, ("id",)).where(F.size("responses") > 0)
    return incremental.run_metrics(derived.qa(spark, sf), written)


@query
def first_row_stats(spark: SparkSession, sf: str) -> DataFrame:
    first = incremental.head_sample(derived.packages(spark, sf, SCORED), 1)
    return _rounded(distributions.overall_stats(first.select(F.inline("responses"))))


@query
def read_packages_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Package text through CSV and back, then parsed."""
    path = shared_dir(spark, "packages-csv")
    text = derived.package_text(spark, sf)
    tables.write_csv(text.select("id", "query", "og_positive", "instruction", "response"), path)
    read = tables.read_packages(spark, path).select(
        F.col("ID").cast("bigint").alias("id"), F.lit(0).alias("choice_index"),
        F.col("Query").alias("query"), F.col("OgPositive").alias("og_positive"),
        F.col("Instruction").alias("instruction"), F.col("Response").alias("response"),
    )
    parsed = parsing.parse_items(read)
    return parsed.select("id", "query", "og_positive", "instruction", F.size("items").alias("passages"))


@query
def analyse_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Package text through CSV and the whole analysis: label statistics."""
    path = shared_dir(spark, "analyse-csv")
    text = derived.package_text(spark, sf)
    tables.write_csv(text.select("id", "query", "og_positive", "instruction", "response"), path)
    return _rounded(flows.analyse(tables.package_rows(tables.read_packages(spark, path)))["label_stats"])


@query
def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Q&A rows in two CSV folders of different column order, some records with a field too many or too few."""
    path = shared_dir(spark, "csv-rejects")
    rows = derived.qa(spark, sf).select(
        F.col("id").cast("string").alias("ID"), F.lit("q").alias("Question"), F.lit("a").alias("Answer"))
    spelled = F.when(F.col("ID") % 10 == 3, F.concat_ws(",", "ID", "Question", "Answer", F.lit("more"))).when(
        F.col("ID") % 10 == 4, F.concat_ws(",", "ID", "Question")).otherwise(F.concat_ws(",", "ID", "Question", "Answer"))
    for part, (header, line) in enumerate((("ID,Question,Answer", spelled), ("Answer,ID,Question", F.concat_ws(",", "Answer", "ID", "Question")))):
        lines = rows.where(F.col("ID") % 2 == part) if part else rows.where((F.col("ID") % 2 == 0) | (F.col("ID") % 10 == 3))
        lines.select(line.alias(header)).write.mode("append").options(header="true", quote="", escapeQuotes="false", sep="\u0001").csv(path)
    read = tables.read_csv(spark, path)
    good = tables.qa_of(read).select(F.lit("good").alias("kind"), "id", F.col("answer").alias("text"))
    bad = tables.rejects_of(read).select(F.col("reason").alias("kind"), "id", F.col("raw").alias("text"))
    return good.unionByName(bad)


@query
def score_string_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Packages with text ids stored, read back, scored and routed."""
    path = shared_dir(spark, "string-ids")
    built = derived.packages(spark, sf).withColumn("id", F.concat(F.lit("a"), F.col("id")))
    tables.append_packages(built, path)
    read = tables.read_package_parquet(spark, path, "string")
    pairs = relevance.relevance_pairs(parsing.explode_candidates(read, "query", "instruction"))
    narrow = parsing.explode_candidates(read, fields=("label",))
    routed = relevance.route_candidates(narrow, relevance.pair_logits(relevance.score_pairs(pairs, word_scorer())))
    return routed.select("id", "pos", "bucket")


@query
def verdict_score_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of continuous scores: each passage's share of distinct words."""
    worded = _worded(spark, sf).select("label", F.split("passage", " ").alias("w")).select(
        "label", (F.size(F.array_distinct("w")) / F.size("w") - F.size("w") / 100003.0).alias("confidence"))
    return _rounded(distributions.label_stats(worded))


@query
def read_qa_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Q&A rows through CSV and back, without their metadata columns."""
    path = shared_dir(spark, "qa-csv")
    qa = derived.qa(spark, sf).select(
        F.col("id").alias("ID"), F.col("question").alias("Question"), F.col("answer").alias("Answer"),
        "chunk", F.lit("none").alias("Keywords"),
    )
    tables.write_csv(qa, path)
    return tables.drop_metadata(tables.read_qa(spark, path)).withColumn("id", F.col("id").cast("bigint"))


@query
def append_packages(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, the second only of what the first left out, then the table read back."""
    path = shared_dir(spark, "packages")
    built = derived.packages(spark, sf)
    tables.append_packages(incremental.pending(built, derived.done(spark, sf)), path)
    stored = tables.read_package_parquet(spark, path)
    tables.append_packages(incremental.pending(built, stored), path)
    return tables.read_package_parquet(spark, path).select("id", F.size("responses").alias("passages"))


@query
def write_filtered(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "filtered")
    kept = relevance.filtered_passages(derived.candidates(spark, sf), derived.logits(spark, sf))
    tables.write_filtered(kept, path)
    return spark.read.parquet(path)


@query
def stream_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests built from a file stream that is stopped and started again."""
    folder = shared_dir(spark, "stream")
    derived.qa(spark, sf).write.parquet(f"{folder}/qa")
    for _ in range(2):
        ingest.run_requests(spark, f"{folder}/qa", f"{folder}/requests", f"{folder}/progress", PROMPTS)
    out = ingest.read_requests(spark, f"{folder}/requests")
    return out.select("request_id", "id", "style", "length", "prompt")


# Requests and completions


@query
def style_length_assign(spark: SparkSession, sf: str) -> DataFrame:
    return requests.assign_variant(derived.conversation_qa(spark, sf)).select("id", "style", "length")


@query
def instruction_prompts(spark: SparkSession, sf: str) -> DataFrame:
    varied = requests.assign_variant(requests.complete_inputs(derived.qa(spark, sf)))
    return requests.render_instruction_prompt(varied, PROMPTS.instruction_template).select("id", "prompt")


@query
def passage_prompts(spark: SparkSession, sf: str) -> DataFrame:
    instructed = derived.packages(spark, sf, ("id",)).withColumnRenamed("query", "question")
    return requests.render_passage_prompt(instructed, PROMPTS.passage_template).select("id", "prompt")


@named("requests")
def build_requests(spark: SparkSession, sf: str) -> DataFrame:
    built = flows.instruction_requests(derived.conversation_qa(spark, sf), PROMPTS)

    def part(path: str) -> Column:
        return F.get_json_object("body", f"$.{path}")

    return built.select(
        "request_id",
        part("model").alias("model"),
        part("response_format.type").alias("format"),
        part("messages[0].role").alias("first_role"), part("messages[0].content").alias("first_content"),
        part("messages[1].role").alias("second_role"), part("messages[1].content").alias("second_content"),
    )


def _first_requests(spark: SparkSession, sf: str) -> DataFrame:
    return flows.with_request_id(
        requests.assign_variant(requests.complete_inputs(derived.qa(spark, sf))), requests.INSTRUCTION_STAGE
    )


def _second_requests(spark: SparkSession, sf: str) -> DataFrame:
    return flows.with_request_id(derived.qa(spark, sf), requests.PASSAGE_STAGE)


def _run(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Inputs and both completion tables of a whole generation run, read once."""
    return (
        derived.qa(spark, sf),
        intake.classified(derived.instruction_completions(spark, sf), requests.INSTRUCTION_STAGE),
        intake.classified(derived.passage_completions(spark, sf), requests.PASSAGE_STAGE),
    )


@query
def instruction_intake(spark: SparkSession, sf: str) -> DataFrame:
    taken = intake.intake_instruction(_first_requests(spark, sf), derived.instruction_completions(spark, sf))
    return taken.select("id", "style", "length", "instruction")


@query
def passage_intake(spark: SparkSession, sf: str) -> DataFrame:
    taken = intake.intake_passages(_second_requests(spark, sf), derived.passage_completions(spark, sf))
    return taken.select(
        "id", "choice_index", F.json_array_length("examples").alias("passages"),
    )


@query
def passage_intake_skip_choice(spark: SparkSession, sf: str) -> DataFrame:
    taken = intake.intake_passages(
        _second_requests(spark, sf), derived.passage_completions(spark, sf), on_bad="skip_choice"
    )
    return taken.select("id", "choice_index")


@query
def packages(spark: SparkSession, sf: str) -> DataFrame:
    """The whole generation flow, down to one row per passage."""
    text = flows.generated_packages(*_run(spark, sf))
    nested = parsing.to_responses(parsing.parse_items(text))
    return parsing.explode_candidates(nested, "query", "instruction", "style", "length").select(
        "id", "choice_index", "query", "instruction", "style", "length", "pos", "label", "passage", "confidence"
    )


@query
def intake_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return flows.generation_rejects(*_run(spark, sf)).select("stage", "id", "choice_index", "reason")


# Parsing


def _flat(packages: DataFrame) -> DataFrame:
    return parsing.explode_candidates(packages)


@query
def parse_json_packages(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parsing.parse_items(derived.package_text(spark, sf), mode="json")
    return _flat(parsing.to_responses(parsed))


@query
def parse_literal_packages(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parsing.parse_items(derived.package_text(spark, sf), mode="literal")
    return _flat(parsing.to_responses(parsed))


@query
def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(parsing.to_responses(parsing.parse_items(derived.package_text(spark, sf))))


@query
def confidence_strict(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parsing.strict_packages(parsing.parse_items(derived.package_text(spark, sf)))
    return _flat(parsing.to_responses(parsed)).select("id", "pos", "label", "confidence")


@query
def confidence_probe(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parsing.parse_items(derived.package_text(spark, sf), drop_non_dict=True)
    return _flat(parsing.to_responses(parsed, scores="probe")).select("id", "item_id", "confidence")


@query
def parse_rejects(spark: SparkSession, sf: str) -> DataFrame:
    parsed = parsing.parse_items(derived.package_text(spark, sf))
    return parsing.parse_rejects(parsed).select("id", "reason")


@named("label_class")
def label_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    classed = derived.scores(spark, sf).select("label", label_class(F.col("label")).alias("label_class"))
    return classed.groupBy("label", "label_class").agg(F.count(F.lit(1)).alias("n"))


# Distributions


@query
def overall_confidence_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.overall_stats(derived.scores(spark, sf)))


@query
def label_confidence_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.label_stats(derived.scores(spark, sf)))


@query
def label_share(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.label_share(derived.scores(spark, sf)))


def _shape(spark: SparkSession, sf: str, measure: str) -> DataFrame:
    counts = distributions.score_counts(derived.scores(spark, sf))
    return _rounded(distributions.moments(counts).select("label_class", measure))


@query
def confidence_skewness(spark: SparkSession, sf: str) -> DataFrame:
    return _shape(spark, sf, "skewness")


@query
def confidence_kurtosis(spark: SparkSession, sf: str) -> DataFrame:
    return _shape(spark, sf, "kurtosis")


@query
def responses_per_query(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.responses_per_query(derived.packages(spark, sf, ("confidence",))))


@query
def query_level_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.query_threshold_distribution(derived.packages(spark, sf, SCORED)))


@query
def confidence_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.histogram(derived.scores(spark, sf)))


@query
def confidence_density(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.density_histogram(derived.scores(spark, sf)))


@query
def confidence_box(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.box_summary(derived.scores(spark, sf)))


@query
def confidence_ecdf(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(distributions.ecdf(derived.scores(spark, sf)), "score")


# Selection


def _full(spark: SparkSession, sf: str) -> DataFrame:
    return derived.packages(spark, sf, ("id", "label", "passage", "confidence"))


@named("top_positive")
def best_passage(spark: SparkSession, sf: str) -> DataFrame:
    picked = selecting.select_responses(_full(spark, sf))
    return picked.select(
        "id", "top_positive.pos", "top_positive.confidence",
        F.col("top_positive.response.label").alias("label"),
        F.col("top_positive.response.passage").alias("passage"),
    )


@named("top_positive_labelled")
def best_labelled_passage(spark: SparkSession, sf: str) -> DataFrame:
    picked = selecting.ranked_positions(derived.packages(spark, sf, SCORED), respect_label=True)
    return picked.select("id", "top.pos", "top.confidence")


@named("bottom_negatives")
def bottom_negatives_ranked(spark: SparkSession, sf: str) -> DataFrame:
    chosen = selecting.select_responses(_full(spark, sf))
    picked = chosen.select("id", F.posexplode("bottom_negatives").alias("rank", "b"))
    return picked.select(
        "id", "rank", "b.pos", "b.confidence", F.col("b.response.passage").alias("passage")
    )


@query
def filter_responses(spark: SparkSession, sf: str) -> DataFrame:
    chosen = selecting.select_responses(derived.packages(spark, sf, SCORED))
    return chosen.select(
        "id", "query",
        F.col("top_positive.pos").alias("top_pos"),
        F.array_join(F.transform("bottom_negatives", lambda b: b["pos"].cast("string")), ",").alias("bottom_pos"),
        F.size("all_responses").alias("passages"),
    )


@query
def selection_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(selecting.selection_summary(derived.packages(spark, sf, SCORED)))


@query
def selection_preview(spark: SparkSession, sf: str) -> DataFrame:
    return selecting.selection_preview(derived.packages(spark, sf, SCORED))


# Relevance


@query
def relevance_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return relevance.relevance_pairs(derived.candidates(spark, sf)).drop("choice_index")


@query
def relevance_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(relevance.verdicts(derived.logits(spark, sf)).drop("choice_index"))


def word_scorer() -> Callable[[], relevance.Scorer]:
    """Stands in for a model: logits from the numbers of distinct and of all words."""

    def make():
        def score(texts):
            words = texts.str.split(" ")
            return pd.DataFrame({"t": words.map(lambda w: len(set(w)) / 8), "f": words.map(len) / 16})

        return score

    return make


@query
def score_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = relevance.relevance_pairs(derived.candidates(spark, sf))
    return relevance.score_pairs(pairs, word_scorer()).drop("choice_index")


@query
def route_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Candidates scored in their own rows, then routed."""
    return relevance.route_scored(derived.candidates(spark, sf), word_scorer()).select("id", "pos", "bucket")


@query
def label_stats_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Label statistics from the states of three batches, one of which comes twice."""
    path = shared_dir(spark, "states")
    packages = derived.packages(spark, sf, SCORED)
    for part in (0, 1, 2, 1):
        scores = parsing.explode_candidates(packages.where(F.col("id") % 3 == part), fields=("label", "confidence"))
        batches.append_batch(summaries.summarise(scores), path, f"part-{part}")
    described = summaries.describe_state(batches.read_batches(spark, path, summaries.STATE).drop("batch_id"))
    return _rounded(described.drop("median", "q25", "q75"))


@query
def append_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Packages appended in two batches, each delivered twice, then read back."""
    path = shared_dir(spark, "batches")
    built = derived.packages(spark, sf)
    for part in (0, 1, 0, 1):
        batches.append_batch(built.where(F.col("id") % 2 == part), path, f"b{part}")
    return batches.read_batches(spark, path).select("id", F.size("responses").alias("passages"))


@query
def stream_requests_once(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of a file stream in which every id comes in two files, in two runs."""
    folder = shared_dir(spark, "stream-once")
    qa = derived.qa(spark, sf)
    for _ in range(2):
        qa.write.mode("append").parquet(f"{folder}/qa")
        # All files of a copy are one batch, however many tasks wrote them.
        files = len(spark.read.schema(ingest.QA_SCHEMA).parquet(f"{folder}/qa").inputFiles())
        ingest.run_requests_once(spark, f"{folder}/qa", f"{folder}/requests", f"{folder}/progress", PROMPTS, max_files=files)
    out = batches.read_batches(spark, f"{folder}/requests")
    return out.select("request_id", "id", "style", "length", "prompt")


@query
def route_candidates(spark: SparkSession, sf: str) -> DataFrame:
    candidates = parsing.explode_candidates(derived.packages(spark, sf, ("label",)), fields=("label",))
    routed = relevance.route_candidates(candidates, derived.logits(spark, sf), keep_unlabelled=True)
    return _rounded(routed.drop("choice_index"))


@query
def filtered_passages(spark: SparkSession, sf: str) -> DataFrame:
    return relevance.filtered_passages(derived.candidates(spark, sf), derived.logits(spark, sf))


@query
def filter_summary(spark: SparkSession, sf: str) -> DataFrame:
    candidates = parsing.explode_candidates(derived.packages(spark, sf, ("label",)), fields=("label",))
    return relevance.filter_summary(relevance.route_candidates(candidates, derived.logits(spark, sf)))


# Checks


@query
def check_counts(spark: SparkSession, sf: str) -> DataFrame:
    return contract.check_counts(derived.packages(spark, sf, ("id", "label"))).drop("choice_index")


def _worded(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("label", "passage")
    return parsing.explode_candidates(derived.packages(spark, sf, fields), fields=fields)


@query
def check_word_length(spark: SparkSession, sf: str) -> DataFrame:
    return contract.check_word_length(_worded(spark, sf)).drop("choice_index")


@query
def check_failure_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Failure modes of every package; the third passage of some names one that is not known."""
    packages = derived.packages(spark, sf, ("label", "neg_type"))
    planted = packages.withColumn("responses", F.transform("responses", lambda r, i: F.when(
        (i == 2) & (F.col("id") % 67 == 3), r.withField("neg_type", F.lit("made_up"))).otherwise(r)))
    return contract.check_failure_modes(planted).drop("choice_index")


@query
def check_fields(spark: SparkSession, sf: str) -> DataFrame:
    fields = ("label", "neg_type", "explanation", "why_relevant", "confidence")
    return contract.check_fields(derived.packages(spark, sf, fields)).drop("choice_index")


@query
def check_evidence(spark: SparkSession, sf: str) -> DataFrame:
    cited = derived.packages(spark, sf, ("id", "evidence"))
    return contract.check_evidence(cited, derived.chunks(spark, sf)).drop("choice_index")


@query
def check_error_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Error envelopes; every other one reports an error that is not known."""
    completions = derived.passage_completions(spark, sf)
    other = F.split_part("request_id", F.lit(":"), F.lit(2)).cast("bigint") % 26 == 0
    planted = F.when(other, F.replace("content", F.lit(ERROR_TOO_FEW_NEGATIVES), F.lit("OUT_OF_IDEAS"))).otherwise(F.col("content"))
    return contract.check_error_envelope(completions.withColumn("content", planted))


@query
def check_answer_leak(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(contract.check_answer_leak(derived.packages(spark, sf, ("id",))).drop("choice_index"))


@query
def check_variant_echo(spark: SparkSession, sf: str) -> DataFrame:
    taken = intake.intake_instruction(_first_requests(spark, sf), derived.instruction_completions(spark, sf))
    return contract.check_variant_echo(taken)


@query
def check_doc_partition(spark: SparkSession, sf: str) -> DataFrame:
    return contract.check_doc_partition(derived.doc_partition_completions(spark, sf)).drop("choice_index")


@query
def rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    checked = contract.check_word_length(_worded(spark, sf)).withColumnRenamed("ok", "word_length")
    return contract.violations(checked, "word_length")


# Reports


@query
def yield_audit(spark: SparkSession, sf: str) -> DataFrame:
    tables_in = _run(spark, sf)
    return reports.yield_audit(
        tables_in[0], flows.generated_packages(*tables_in), flows.generation_rejects(*tables_in)
    )


@query
def variant_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return reports.variant_coverage(derived.packages(spark, sf, ("id",)))


@query
def failure_mode_coverage(spark: SparkSession, sf: str) -> DataFrame:
    negatives = derived.packages(spark, sf, ("label", "neg_type", "confidence")).select(F.inline("responses"))
    return _rounded(reports.failure_mode_coverage(negatives))


@query
def dataset_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dataset_counts(derived.packages(spark, sf, ("id", "label")))


@query
def training_pairs(spark: SparkSession, sf: str) -> DataFrame:
    wanted = derived.packages(spark, sf, ("label", "neg_type", "passage"))
    return reports.training_pairs(wanted).drop("choice_index")


@query
def training_unpaired(spark: SparkSession, sf: str) -> DataFrame:
    return reports.unpaired_packages(derived.packages(spark, sf, ("label",))).drop("choice_index")
