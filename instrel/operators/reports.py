"""Reports on a whole data set, and the training export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.constants import LENGTHS, NEGATIVE, POSITIVE, STYLES
from instrel.functions.nested import members
from instrel.functions.once import with_once
from instrel.functions.scores import is_score, label_class
from instrel.operators.relevance import combine_query


def yield_audit(inputs: DataFrame, packages: DataFrame, rejects: DataFrame) -> DataFrame:
    """Outcome of every input, counted: ``packaged``, a reject reason, or ``unknown``.

    An input without a package counts under the alphabetically first of its
    reasons, other than that a choice was lost with its request.
    """
    packaged = packages.select(F.col("id").cast("string").alias("id")).distinct()
    own = F.when(F.col("reason") != "row_lost", F.col("reason"))
    reasons = rejects.groupBy("id").agg(F.min(own).alias("reason"))
    outcome = (
        inputs.select(F.col("id").cast("string").alias("id"))
        .join(packaged.withColumn("packaged", F.lit(True)), "id", "left")
        .join(reasons, "id", "left")
    )
    return outcome.groupBy(
        F.when(F.col("packaged"), "packaged").otherwise(F.coalesce("reason", F.lit("unknown"))).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("inputs"))


def variant_coverage(df: DataFrame) -> DataFrame:
    """Rows per style and length, with totals (``all``); a combination that never occurs counts 0."""
    spark = df.sparkSession
    counted = df.cube("style", "length").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))
    # grouping_id: bit 2 = style rolled up, bit 1 = length rolled up.
    named = counted.select(
        F.when(F.col("gid").bitwiseAND(2) != 0, "all").otherwise(F.col("style")).alias("style"),
        F.when(F.col("gid").bitwiseAND(1) != 0, "all").otherwise(F.col("length")).alias("length"),
        "n",
    )
    cells = [(style, length) for style in [*STYLES, "all"] for length in [*LENGTHS, "all"]]
    wanted = spark.createDataFrame(cells, "style string, length string")
    return wanted.join(named, ["style", "length"], "full").select(
        "style", "length", F.coalesce("n", F.lit(0)).alias("n")
    )


def failure_mode_coverage(candidates: DataFrame) -> DataFrame:
    """Negatives per failure mode and their mean score."""
    scored = F.when(is_score(F.col("confidence")), F.col("confidence"))
    return candidates.where(F.col("label") == NEGATIVE).groupBy("neg_type").agg(
        F.count(F.lit(1)).alias("passages"), F.avg(scored).alias("mean_confidence")
    )


def dataset_counts(packages: DataFrame) -> DataFrame:
    """Inputs, packages and passages of the data set.

    Counted per input first: an input with very many packages is one row after
    the shuffle, and distinct inputs need no second one.
    """

    def label(wanted):
        return F.sum(F.size(F.filter("responses.label", lambda label: label_class(label) == wanted)))

    per_input = packages.groupBy("id").agg(
        F.count(F.lit(1)).alias("packages"),
        F.sum(F.size("responses.label")).alias("passages"),
        label(POSITIVE).alias("positives"),
        label(NEGATIVE).alias("negatives"),
    )
    sums = [
        F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("packages", "passages", "positives", "negatives")
    ]
    return per_input.agg(F.count(F.lit(1)).alias("entries"), *sums)


def _positions(label: str) -> Column:
    """Positions in ``r`` of the passages with this label."""
    marked = F.transform("r.label", lambda given, i: F.when(given == label, i))
    return F.filter(marked, lambda i: i.isNotNull())


def unpaired_packages(packages: DataFrame) -> DataFrame:
    """Packages that ``training_pairs`` gives no row for, as they lack a positive or a negative."""
    has = {label: F.coalesce(F.array_contains("responses.label", label), F.lit(False)) for label in (POSITIVE, NEGATIVE)}
    read = packages.select(
        "id", "choice_index", F.lit("unpaired").alias("reason"),
        *(test.alias(f"has_{label}") for label, test in has.items()))
    return read.where(~(F.col("has_positive") & F.col("has_negative")))


def training_pairs(packages: DataFrame) -> DataFrame:
    """(query with instruction, positive, negative) rows.

    A package by contract has one positive, which goes with each negative. If it
    has more, they take turns: every passage is used, and the rows stay as many
    as the longer of both lists instead of their product.
    """
    read = with_once(
        packages.select("id", "choice_index", "query", "instruction", "responses"),
        r=members("responses", "label", "passage", "neg_type"),
    ).drop("responses")
    read = with_once(read, p=_positions(POSITIVE), n=_positions(NEGATIVE)).where((F.size("p") > 0) & (F.size("n") > 0))
    rows = F.sequence(F.lit(0), F.greatest(F.size("p"), F.size("n")) - 1)

    def pair(i: Column) -> Column:
        positive = F.get("r", F.get("p", i % F.size("p")))
        negative = F.get("r", F.get("n", i % F.size("n")))
        return F.struct(
            i.alias("row"),
            positive["passage"].alias("positive"),
            negative["passage"].alias("negative"),
            negative["neg_type"].alias("neg_type"),
        )

    query = combine_query(F.col("query"), F.col("instruction")).alias("query")
    return read.select("id", "choice_index", query, F.inline(F.transform(rows, pair)))
