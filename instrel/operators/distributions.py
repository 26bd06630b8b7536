"""Score distributions.

Raw scores are reduced to (group, score, count) first, with map-side combine, so
the raw rows are scanned once and a score that a third of all rows share is one
row after the shuffle. Everything else works on that table. Moments are sums over
it. Order statistics need the running count over the sorted scores; one sorted
window per group would put a whole group into one task, so the table is sorted
by range partitioning, counted inside each partition, and each partition starts
from the counts of those before it. Spark draws the ranges by sampling, and their number is
that of the shuffle partitions, so a range stays small however many scores there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from instrel.constants import HISTOGRAM_BINS, NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD
from instrel.functions.scores import is_score, label_class
from instrel.session import shared_dir

OVERALL = "overall"


def score_counts(candidates: DataFrame, overall: bool = True, by_label: bool = True) -> DataFrame:
    """(grp, score, n) for all passages together and for each label class.

    Each raw row is counted once; the counts of all passages are sums of the labels' counts.
    """
    # Exploded, so that the group stays a column and is no constant that joins and groupings drop.
    grp = label_class(F.col("label")) if by_label else F.explode(F.array(F.lit(OVERALL)))
    counts = candidates.where(is_score(F.col("confidence"))).select(
        grp.alias("grp"), (F.col("confidence") + 0.0).alias("score")
    ).groupBy("grp", "score").agg(F.count(F.lit(1)).alias("n"))
    if not overall or not by_label:
        return counts
    both = counts.select(F.explode(F.array(F.lit(OVERALL), F.col("grp"))).alias("grp"), "score", "n")
    return both.groupBy("grp", "score").agg(F.sum("n").alias("n"))


def ranked_scores(counts: DataFrame) -> DataFrame:
    """Add to (grp, score, n): ``cum``, the count of scores up to this one, and the group's ``total`` count.

    The sorted table is written to the shared folder, so that both its rows and its
    partitions' totals come from the same ranges. There are at most three groups for each partition, which
    bounds the table of totals that is broadcast.
    """
    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, carried = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            groups = batch.column("grp").dictionary_encode()
            codes, n = groups.indices.to_numpy(), batch.column("n").to_numpy()
            within = np.cumsum(n)
            # Rows come sorted by group: each starts again from 0, and the first goes on with the batch before.
            starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
            offset = np.repeat(within[starts] - n[starts], np.diff(np.append(starts, len(n))))
            within = within - offset
            if groups.dictionary[codes[0]].as_py() == last:
                within[: starts[1] if len(starts) > 1 else len(n)] += carried
            last, carried = groups.dictionary[codes[-1]].as_py(), int(within[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(within), pa.array(np.full(len(n), part, dtype=np.int32))], ["grp", "score", "n", "within", "part"])

    spark = counts.sparkSession
    ordered = counts.select("grp", "score", "n").repartitionByRange("grp", "score").sortWithinPartitions("grp", "score")
    path = shared_dir(spark, "ranked-scores")
    shape = "grp string, score double, n bigint, within bigint, part int"
    ordered.mapInArrow(lambda batches: running(b for b in batches if b.num_rows), shape).write.parquet(path)
    ranked = spark.read.schema(shape).parquet(path)
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranked.groupBy("grp", "part").agg(F.sum("n").alias("held")).select(
        "grp", "part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"), F.sum("held").over(group).alias("total"))
    return ranked.join(F.broadcast(totals), ["grp", "part"]).select(
        "grp", "score", "n", (F.col("before") + F.col("within")).alias("cum"), "total")


def _quantile_parts(p: float) -> tuple[Column, Column]:
    """Aggregates: the scores at the two ranks that quantile ``p`` lies between."""
    rank = F.lit(p) * (F.col("total") - 1)
    low = F.min(F.when(F.col("cum") > F.floor(rank), F.col("score")))
    high = F.min(F.when(F.col("cum") > F.ceil(rank), F.col("score")))
    return low, high


def _quantile(p: float) -> Column:
    """Aggregate: quantile with linear interpolation between ranks."""
    low, high = _quantile_parts(p)
    rank = F.lit(p) * (F.max("total") - 1)
    return low + (high - low) * (rank - F.floor(rank))


def _central(power: int) -> Column:
    """Aggregate: population central moment."""
    return F.sum(F.col("n") * F.pow(F.col("score") - F.col("mean"), F.lit(power))) / F.max("total")


def moments(counts: DataFrame) -> DataFrame:
    """One row per group: count, mean, range, variance, skewness and excess kurtosis; needs no order.

    Skewness is 0 for fewer than three scores, excess kurtosis for fewer than
    four, and both where all scores are equal.
    """
    means = counts.groupBy("grp").agg(
        F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("mean"))
    flat = F.col("min") == F.col("max")
    # One row for each of three groups at most.
    described = counts.join(F.broadcast(means), "grp").groupBy("grp").agg(
        F.max("total").alias("count"), F.max("mean").alias("mean"), F.min("score").alias("min"), F.max("score").alias("max"),
        _central(2).alias("variance"), _central(3).alias("m3"), _central(4).alias("m4"),
    )
    return described.select(
        F.col("grp").alias("label_class"), "count", "mean", F.sqrt("variance").alias("std"), "min", "max", "variance",
        F.when((F.col("count") < 3) | flat, 0.0)
        .otherwise(F.col("m3") / F.pow(F.col("variance"), F.lit(1.5))).alias("skewness"),
        F.when((F.col("count") < 4) | flat, 0.0)
        .otherwise(F.col("m4") / F.pow(F.col("variance"), F.lit(2)) - 3.0).alias("kurtosis"),
    )


def describe_scores(counts: DataFrame) -> DataFrame:
    """One row per group: moments, range and quartiles."""
    quartiles = ranked_scores(counts).groupBy("grp").agg(
        _quantile(0.5).alias("median"), _quantile(0.25).alias("q25"), _quantile(0.75).alias("q75"))
    # One row for each of three groups at most.
    return moments(counts).join(F.broadcast(quartiles.withColumnRenamed("grp", "label_class")), "label_class").select(
        "label_class", "count", "mean", "median", "std", "min", "max", "q25", "q75", "variance", "skewness", "kurtosis")


def overall_stats(candidates: DataFrame) -> DataFrame:
    """Description of all scores; no row if there are none."""
    return describe_scores(score_counts(candidates, by_label=False)).select(
        F.col("count").alias("total_responses"), "mean", "median", "std", "min", "max", "q25", "q75"
    )


def label_stats(candidates: DataFrame) -> DataFrame:
    """Description per label class and of all scores, in one pass over the candidates."""
    counts = score_counts(candidates)
    # A condition, not a filter: a filter would move below the shuffle and scan again.
    everything = counts.agg(F.sum(F.when(F.col("grp") == OVERALL, F.col("n")))).scalar()
    return describe_scores(counts).withColumn("percentage", F.col("count") / everything * 100)


def label_share(candidates: DataFrame) -> DataFrame:
    """Scores per label class and their share of all scores in percent."""
    counts = score_counts(candidates, overall=False).groupBy("grp").agg(F.sum("n").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        F.col("grp").alias("label_class"), "count", (F.col("count") / total * 100).alias("percentage")
    )


def any_score(test: Callable[[Column], Column]) -> Column:
    """Does any score of the package meet the test? Reads nothing but the scores."""
    return F.exists("responses.confidence", lambda score: is_score(score) & F.coalesce(test(score), F.lit(False)))


def responses_per_query(packages: DataFrame) -> DataFrame:
    """Number of packages, and mean, largest and smallest number of passages in one."""
    n = F.size("responses.confidence")
    return packages.where(F.col("responses").isNotNull()).agg(
        F.count(F.lit(1)).alias("packages"),
        F.avg(n).alias("avg_responses"),
        F.max(n).alias("max_responses"),
        F.min(n).alias("min_responses"),
    )


def query_threshold_distribution(
    packages: DataFrame, positive: float = POSITIVE_THRESHOLD, negative: float = NEGATIVE_THRESHOLD
) -> DataFrame:
    """Packages with a score at or above / at or below the thresholds, whatever the label."""
    has_high = any_score(lambda score: score >= positive)
    has_low = any_score(lambda score: score <= negative)
    counted = packages.where(F.col("responses").isNotNull()).agg(
        F.count(F.lit(1)).alias("packages"),
        F.count_if(has_high).alias("with_positive"),
        F.count_if(has_low).alias("with_negative"),
        F.count_if(has_high & has_low).alias("with_both"),
    )
    kinds = ("positive", "negative", "both")
    return counted.select(
        "*", *[(F.col(f"with_{k}") / F.col("packages") * 100).alias(f"{k}_percent") for k in kinds]
    )


def histogram(candidates: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins over the range of all scores, empty bins included, last bin closed.

    The bin a division gives is corrected against the bin's own edges, since the
    quotient of a score on an edge may round to either side.
    """
    counts = score_counts(candidates, by_label=False)
    # One value, hence one row: the range, widened if there is only one score.
    equal = F.min("score") == F.max("score")
    pad = F.when(equal, 0.5).otherwise(0.0)
    span = counts.agg(
        F.struct((F.min("score") - pad).alias("lo"), (F.max("score") + pad).alias("hi"),
                 F.sum("n").alias("total"))
    ).scalar()
    lo, hi, step = F.col("span.lo"), F.col("span.hi"), (F.col("span.hi") - F.col("span.lo")) / bins
    guess = F.least(F.floor((F.col("score") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    below = F.col("score") < lo + F.col("guess") * step
    above = (F.col("guess") < bins - 1) & (F.col("score") >= lo + (F.col("guess") + 1) * step)
    filled = (
        counts.withColumn("span", span)
        .withColumn("guess", guess)
        .withColumn("bin", F.when(below, F.col("guess") - 1).when(above, F.col("guess") + 1)
                    .otherwise(F.col("guess")))
        .groupBy("bin").agg(F.sum("n").alias("n"))
    )
    edges = candidates.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("span", span)
    return edges.join(filled, "bin", "left").where(F.col("span.total").isNotNull()).select(
        "bin",
        (lo + F.col("bin") * step).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("count"),
        F.col("span.total").alias("total"),
    )


def density_histogram(candidates: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Histogram whose bars have area one together."""
    width = F.col("bin_end") - F.col("bin_start")
    return histogram(candidates, bins).select(
        "bin", "bin_start", "bin_end", (F.col("count") / (F.col("total") * width)).alias("density")
    )


def box_summary(candidates: DataFrame) -> DataFrame:
    """Quartiles, whiskers (furthest scores within 1.5 IQR) and number of outliers."""
    counts = score_counts(candidates, by_label=False)
    quartiles = ranked_scores(counts).groupBy().agg(
        F.struct(_quantile(0.25).alias("q1"), _quantile(0.5).alias("median"), _quantile(0.75).alias("q3"))
    ).scalar()
    q1, q3 = F.col("q.q1"), F.col("q.q3")
    reach = (q3 - q1) * 1.5
    fenced = counts.withColumn("q", quartiles)
    low = F.min(F.when(F.col("score") >= q1 - reach, F.col("score")))
    high = F.max(F.when(F.col("score") <= q3 + reach, F.col("score")))
    summary = fenced.groupBy("q").agg(
        low.alias("low"), high.alias("high"), F.struct(low.alias("low"), high.alias("high")).alias("w"),
        F.sum("n").alias("count"),
        F.sum(F.when((F.col("score") < q1 - reach) | (F.col("score") > q3 + reach), F.col("n"))
              .otherwise(0)).alias("outliers"),
    )
    return summary.select(
        "count", F.col("q.q1").alias("q1"), F.col("q.median").alias("median"), F.col("q.q3").alias("q3"),
        F.least("low", q1).alias("whisker_low"), F.greatest("high", q3).alias("whisker_high"), "outliers",
    )


def ecdf(candidates: DataFrame) -> DataFrame:
    """Share of scores at or below each distinct score, for all passages and per label class."""
    return ranked_scores(score_counts(candidates)).select(
        F.col("grp").alias("label_class"), "score", "n", (F.col("cum") / F.col("total")).alias("share")
    )
