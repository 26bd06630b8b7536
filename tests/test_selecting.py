from conftest import package_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from instrel.operators import selecting


def picks(packages, **options):
    rows = selecting.select_responses(packages, **options).orderBy("id").collect()
    return [
        (r["top_positive"]["pos"] if r["top_positive"] else None, [b["pos"] for b in r["bottom_negatives"]])
        for r in rows
    ]


def test_ties_go_to_the_earlier_position(spark):
    tied = [("negative", c) for c in (0.8, 0.8, 0.3, 0.1, 0.1, 0.2)]
    assert picks(package_frame(spark, tied)) == [(0, [3, 4, 5])]


def test_package_without_a_pick_is_kept(spark):
    assert picks(package_frame(spark, [("positive", 0.5), ("negative", 0.6)], [])) == [(None, []), (None, [])]


def test_label_matters_only_on_request(spark):
    package = package_frame(spark, [("negative", 0.9), ("positive", 0.7), ("positive", 0.1)])
    assert picks(package) == [(0, [2])]
    assert picks(package, respect_label=True) == [(1, [])]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 10).map(lambda n: n / 10), max_size=8), min_size=1, max_size=20))
def test_equals_stable_sorts(spark, lists):
    wanted = []
    for scores in lists:
        order = sorted(range(len(scores)), key=lambda i: -scores[i])
        low = sorted((i for i in range(len(scores)) if scores[i] <= 0.3), key=lambda i: scores[i])
        wanted.append((order[0] if order and scores[order[0]] >= 0.7 else None, low[:3]))
    assert picks(package_frame(spark, *[[("x", s) for s in scores] for scores in lists])) == wanted


def test_summary_and_preview(spark):
    packages = package_frame(spark, [("positive", 0.95), ("negative", 0.25)], [("negative", 0.5)])
    packages = packages.withColumn("query", F.repeat("query", 30))
    row = selecting.selection_summary(packages).first()
    assert (row["total_queries"], row["with_positive"], row["with_negatives"]) == (2, 1, 1)
    first = selecting.selection_preview(packages).first()
    assert len(first["query_preview"]) <= 103 and first["query_preview"].endswith("...")
    assert (first["top_confidence"], first["negatives"], first["negative_confidences"]) == (0.95, 1, "0.250")


def test_nan_is_never_chosen(spark):
    packages = package_frame(spark, [("positive", float("nan")), ("positive", 0.8), ("negative", float("-inf"))])
    row = selecting.select_responses(packages).first()
    assert row["top_positive"]["pos"] == 1 and row["bottom_negatives"] == []
