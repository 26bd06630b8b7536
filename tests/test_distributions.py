import numpy as np
import pytest
from conftest import package_frame, score_frame
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from instrel.operators import distributions as d

SLOW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def described(spark, scores, label="positive"):
    rows = d.label_stats(score_frame(spark, scores, label)).collect()
    return {r["label_class"]: r.asDict() for r in rows}


def test_known_quartiles_and_shape(spark):
    row = described(spark, [0, 0.4, 0.4, 0.57, 0.68, 0.9, 1])["positive"]
    assert row["q25"] == pytest.approx(0.40) and row["median"] == 0.57 and row["q75"] == pytest.approx(0.79)
    assert row["skewness"] == pytest.approx(-0.307792, abs=1e-6)
    assert row["kurtosis"] == pytest.approx(-0.757979, abs=1e-6)
    assert row["percentage"] == 100.0


@pytest.mark.parametrize("scores", [[0.1, 0.9], [0.5] * 10])
def test_shape_is_zero_for_few_or_equal_scores(spark, scores):
    row = described(spark, scores)["positive"]
    assert row["skewness"] == 0.0 and row["kurtosis"] == 0.0


def test_kurtosis_needs_four_scores(spark):
    row = described(spark, [0.1, 0.2, 0.9])["positive"]
    assert row["skewness"] != 0.0 and row["kurtosis"] == 0.0


def test_no_scores_no_rows(spark):
    empty = score_frame(spark, [0.1]).where("confidence > 1")
    for report in (d.overall_stats, d.label_stats, d.histogram, d.box_summary, d.ecdf, d.label_share):
        assert report(empty).count() == 0


def test_nan_and_null_are_no_scores(spark):
    frame = spark.createDataFrame([("a", float("nan")), ("a", None), ("a", 0.5)], "label string, confidence double")
    assert d.overall_stats(frame).first()["total_responses"] == 1


def test_unknown_label_counts_as_negative(spark):
    assert set(described(spark, [0.1], "Positive")) == {"negative", "overall"}


@SLOW
@given(st.lists(st.one_of(st.floats(0, 1), st.integers(0, 100).map(lambda n: n / 100)), min_size=1, max_size=300))
def test_equals_numpy(spark, scores):
    row, x = described(spark, scores)["positive"], np.array(scores)
    assert row["count"] == len(x)
    wanted = {
        "mean": x.mean(), "median": np.median(x), "std": x.std(), "variance": x.var(), "min": x.min(), "max": x.max(),
        "q25": np.percentile(x, 25), "q75": np.percentile(x, 75),
    }
    for name, value in wanted.items():
        assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-9), name


def test_ranges_do_not_change_ranks(spark):
    rng = np.random.default_rng(1)
    # A third of all rows share one score.
    scores = np.concatenate([rng.random(600), np.full(300, 0.25)])
    counts = d.score_counts(score_frame(spark, scores)).cache()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for ranges in (1, 2, 7, 32):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        rows = d.ranked_scores(counts).where("grp = 'overall'").collect()
        spark.conf.set("spark.sql.shuffle.partitions", before)
        assert len(rows) == len(np.unique(scores))
        for r in rows[:50]:
            assert r["cum"] == (scores <= r["score"]).sum()
    counts.unpersist()


@pytest.mark.parametrize("scores", [[i / 100 for i in range(101)] * 3, [0.5] * 10, [0.1, 0.2, 0.7, 0.7000001]])
def test_histogram_equals_numpy(spark, scores):
    wanted, edges = np.histogram(scores, bins=50)
    rows = d.histogram(score_frame(spark, scores)).orderBy("bin").collect()
    assert [r["count"] for r in rows] == wanted.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())
    density = [r["density"] for r in d.density_histogram(score_frame(spark, scores)).orderBy("bin").collect()]
    assert density == pytest.approx(np.histogram(scores, bins=50, density=True)[0].tolist())


def test_box_whiskers_and_outliers(spark):
    row = d.box_summary(score_frame(spark, [0.0, 0.5, 0.52, 0.54, 0.56, 0.58, 1.0])).first()
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["count"]) == (0.5, 0.58, 2, 7)


def test_ecdf_has_one_step_per_distinct_score(spark):
    rows = d.ecdf(score_frame(spark, [0.1, 0.1, 0.4, 0.9])).where("label_class = 'positive'").orderBy("score").collect()
    assert [(r["score"], r["n"], r["share"]) for r in rows] == [(0.1, 2, 0.5), (0.4, 1, 0.75), (0.9, 1, 1.0)]


def test_package_level_counts(spark):
    packages = package_frame(spark, [("positive", 0.9), ("negative", 0.2)], [("negative", 0.8)], [])
    assert tuple(d.responses_per_query(packages).first()) == (3, 1.0, 2, 0)
    row = d.query_threshold_distribution(packages).first()
    assert (row["packages"], row["with_positive"], row["with_negative"], row["with_both"]) == (3, 2, 1, 1)
