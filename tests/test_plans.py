"""What the plans must and must not contain."""

import re
import subprocess
import sys

import pytest
from pyspark import cloudpickle

from instrel.functions.literals import literal_as_json
from instrel.operators import contract, distributions, parsing, reports, selecting
from instrel.plans import catalog, derived
from instrel.sources import tables


def plan(frame):
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 100000)
    return frame._jdf.queryExecution().executedPlan().toString()


def executed_shuffles(text, keys):
    """Ids of the shuffles on the given keys that were run, reused ones once."""
    lines = text.splitlines()
    return {
        re.search(r"plan_id=(\d+)", line).group(1)
        for stage, line in zip(lines, lines[1:])
        if "ShuffleQueryStage" in stage and re.search(rf"\+- Exchange hashpartitioning\({keys}", line)
    }


def read_schema(text):
    return re.search(r"ReadSchema: (.*)", text).group(1)


@pytest.mark.parametrize(
    "name", ["filter_responses", "check_counts", "check_failure_modes", "check_fields", "check_doc_partition"]
)
def test_row_local_operators_do_not_shuffle(spark, sf, name):
    assert "Exchange" not in plan(catalog.queries()[name](spark, sf))


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - {"append_packages", "stream_requests"}))
def test_no_cross_join_and_no_window_over_raw_rows(spark, sf, name):
    text = plan(catalog.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert window.startswith("grp#")


@pytest.mark.parametrize("name, shuffles", [("label_confidence_stats", 2), ("confidence_ecdf", 0), ("confidence_box", 1), ("confidence_histogram", 1)])
def test_raw_scores_are_scanned_once(spark, sf, name, shuffles):
    """Once by label, and the labels' counts once more for all; ranked scores are read from the stored table."""
    frame = catalog.queries()[name](spark, sf)
    frame.collect()
    assert len(executed_shuffles(plan(frame), r"grp#\d+, score#")) == shuffles


@pytest.mark.parametrize("name", ["passage_intake", "packages", "check_answer_leak", "instruction_prompts"])
def test_scans_are_not_dealt_anew(spark, sf, name):
    assert "RoundRobinPartitioning" not in plan(catalog.queries()[name](spark, sf))


def test_scores_read_no_text(spark, sf):
    assert read_schema(plan(derived.scores(spark, sf))) == "struct<doc_id:bigint>"


def test_stored_packages_read_only_the_fields_used(spark, sf, tmp_path):
    tables.append_packages(derived.packages(spark, sf), str(tmp_path / "p"))
    stored = tables.read_package_parquet(spark, str(tmp_path / "p"))
    narrow = parsing.explode_candidates(stored, fields=("label", "confidence"))
    for frame, wanted in (
        (distributions.overall_stats(narrow), {"confidence"}),
        (distributions.label_stats(narrow), {"label", "confidence"}),
        (distributions.responses_per_query(stored), {"confidence"}),
        (distributions.query_threshold_distribution(stored), {"confidence"}),
        (selecting.selection_summary(stored), {"confidence"}),
        (selecting.ranked_positions(stored).select("id", "top", "bottom"), {"confidence"}),
        (contract.check_counts(stored), {"label"}),
        (contract.check_failure_modes(stored), {"label", "neg_type"}),
        (reports.dataset_counts(stored), {"label"}),
        (reports.training_pairs(stored), {"label", "passage", "neg_type"}),
    ):
        nested = re.search(r"responses:array<struct<(.*?)>>", read_schema(plan(frame))).group(1)
        assert {field.split(":")[0] for field in nested.split(",")} <= wanted | {"label"}, nested


def test_functions_sent_to_workers_carry_what_they_need():
    functions = cloudpickle.dumps((literal_as_json().func, catalog.word_scorer()))
    load = "import pickle, sys, pandas as pd; f, m = pickle.load(sys.stdin.buffer); print(f(pd.Series(['[1]']))[0], len(m()(pd.Series(['a b']))))"
    done = subprocess.run([sys.executable, "-c", load], input=functions, capture_output=True, cwd="/", timeout=60)
    assert done.stdout.split() == [b"[1]", b"1"], done.stderr.decode()
