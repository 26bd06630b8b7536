"""Score statistics that grow by increments.

A state has one row for each label class: count, mean, sums of the second to
fourth powers of the distances from the mean, range, and a quantile sketch. It
is made in one pass over a batch of passages, by aggregates that add up in each
task first. States of several batches merge to the state of all: the moments as
they are of all scores, the sketches within their error. A run over new inputs
thus reads those alone, and the statistics of everything cost one row a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.functions.scores import is_score, label_class
from instrel.operators.distributions import OVERALL

#: Size of a sketch. The rank of a quantile it gives is off by more than ``RANK_ERROR`` of all scores in about one of a hundred cases.
SKETCH, RANK_ERROR = 400, 0.01
STATE = "label_class string, count bigint, mean double, m2 double, m3 double, m4 double, min double, max double, sketch binary"
_COLUMNS = ["label_class", "count", "mean", "m2", "m3", "m4", "min", "max", "sketch"]


def summarise(candidates: DataFrame, sketch: int = SKETCH) -> DataFrame:
    """The state of one batch; scores that are none are left out, a class without scores has no row."""
    score = F.col("confidence") + 0.0
    found = candidates.where(is_score(F.col("confidence"))).groupBy(label_class(F.col("label")).alias("label_class")).agg(
        F.count(F.lit(1)).alias("count"), F.avg(score).alias("mean"), F.var_pop(score).alias("variance"),
        F.skewness(score).alias("skewness"), F.kurtosis(score).alias("kurtosis"), F.min(score).alias("min"), F.max(score).alias("max"),
        F.kll_sketch_agg_double(score, F.lit(sketch)).alias("sketch"))
    n, variance = F.col("count"), F.col("variance")
    third, fourth = F.col("skewness") * F.pow(variance, F.lit(1.5)) * n, (F.col("kurtosis") + 3.0) * F.pow(variance, F.lit(2)) * n
    return found.select(
        "label_class", "count", "mean", (variance * n).alias("m2"), F.coalesce(third, F.lit(0.0)).alias("m3"),
        F.coalesce(fourth, F.lit(0.0)).alias("m4"), "min", "max", "sketch")


def merge_states(states: DataFrame) -> DataFrame:
    """One row for each label class of any number of states."""
    means = states.groupBy(F.col("label_class").alias("of")).agg((F.sum(F.col("count") * F.col("mean")) / F.sum("count")).alias("centre"))
    off = F.col("mean") - F.col("centre")
    n, m2, m3 = F.col("count"), F.col("m2"), F.col("m3")
    # A row for each label class: two, and that of all scores.
    return states.join(F.broadcast(means), F.col("label_class") == F.col("of")).groupBy("label_class").agg(
        F.sum("count").alias("count"), F.max("centre").alias("mean"),
        F.sum(m2 + n * off * off).alias("m2"), F.sum(m3 + 3 * off * m2 + n * F.pow(off, F.lit(3))).alias("m3"),
        F.sum(F.col("m4") + 4 * off * m3 + 6 * off * off * m2 + n * F.pow(off, F.lit(4))).alias("m4"),
        F.min("min").alias("min"), F.max("max").alias("max"), F.kll_merge_agg_double("sketch").alias("sketch")).select(*_COLUMNS)


def quantile(p: float) -> Column:
    """The score at about this share of all scores, by the sketch."""
    return F.kll_sketch_get_quantile_double("sketch", F.lit(p))


def describe_state(states: DataFrame) -> DataFrame:
    """``label_stats`` of all batches, with quartiles by the sketch.

    The quartiles are scores of the batches whose rank is off by ``RANK_ERROR`` at most, but for one case in a hundred.
    """
    classes = merge_states(states)
    both = classes.unionByName(merge_states(classes.withColumn("label_class", F.explode(F.array(F.lit(OVERALL))))))
    n, variance, flat = F.col("count"), F.col("m2") / F.col("count"), F.col("min") == F.col("max")
    everything = F.max(F.when(F.col("label_class") == OVERALL, n))
    total = both.agg(everything).scalar()
    return both.select(
        "label_class", "count", "mean", quantile(0.5).alias("median"), F.sqrt(variance).alias("std"), "min", "max",
        quantile(0.25).alias("q25"), quantile(0.75).alias("q75"), variance.alias("variance"),
        F.when((n < 3) | flat, 0.0).otherwise(F.col("m3") / n / F.pow(variance, F.lit(1.5))).alias("skewness"),
        F.when((n < 4) | flat, 0.0).otherwise(F.col("m4") / n / F.pow(variance, F.lit(2)) - 3.0).alias("kurtosis"),
        (n / total * 100).alias("percentage"))


def box_by_sketch(states: DataFrame, candidates: DataFrame) -> DataFrame:
    """Quartiles by the sketch, then whiskers and outliers of all scores by one more pass, without sorting them."""
    whole = merge_states(merge_states(states).withColumn("label_class", F.explode(F.array(F.lit(OVERALL)))))
    quartiles = whole.agg(F.max(F.struct(quantile(0.25).alias("q1"), quantile(0.5).alias("median"), quantile(0.75).alias("q3")))).scalar()
    scores = candidates.where(is_score(F.col("confidence"))).select((F.col("confidence") + 0.0).alias("score")).withColumn("q", quartiles)
    q1, q3 = F.col("q.q1"), F.col("q.q3")
    reach = (q3 - q1) * 1.5
    inside = F.col("score").between(q1 - reach, q3 + reach)
    return scores.groupBy("q").agg(
        F.count(F.lit(1)).alias("count"), F.min(F.when(inside, F.col("score"))).alias("low"),
        F.max(F.when(inside, F.col("score"))).alias("high"), F.count_if(~inside).alias("outliers")).select(
        "count", q1.alias("q1"), F.col("q.median").alias("median"), q3.alias("q3"),
        F.least("low", q1).alias("whisker_low"), F.greatest("high", q3).alias("whisker_high"), "outliers")
