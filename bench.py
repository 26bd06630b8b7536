"""Time the headline queries; prints one JSON line.

Every query writes all its rows to a sink that drops them. Each is run once to
warm up and then ``BENCH_RUNS`` times (default 3); the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from instrel.plans.catalog import queries
from instrel.session import local_session

HEADLINE = [
    "label_confidence_stats", "confidence_ecdf", "confidence_histogram", "query_level_distribution",
    "filter_responses", "bottom_negatives", "candidates", "confidence_probe",
    "instruction_prompts", "instruction_intake", "passage_intake", "packages", "yield_audit",
    "pending_rows", "relevance_pairs", "filtered_passages", "check_word_length", "check_answer_leak",
    "variant_coverage", "training_pairs",
]


def run(spark, build, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores)
    registered = queries()
    seconds = {}
    for name in HEADLINE:
        run(spark, registered[name], folder)
        seconds[name] = round(statistics.median(run(spark, registered[name], folder) for _ in range(runs)), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total of median times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
