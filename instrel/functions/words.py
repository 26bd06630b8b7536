"""Words, word n-grams and normalised text, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from instrel.functions.once import with_once


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters."""
    return F.regexp_count(text, F.lit(r"\S+"))


def normalised(text: Column) -> Column:
    """Lower case, every run of characters that are no letter or digit is one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def with_ngrams(df: DataFrame, text: str, name: str, n: int) -> DataFrame:
    """Add the distinct word n-grams of a column of normalised text, as 64-bit hashes."""
    df = with_once(df, _words=F.split(text, " "))
    starts = F.when(
        F.size("_words") >= n, F.sequence(F.lit(0), F.size("_words") - F.lit(n))
    ).otherwise(F.array().cast("array<int>"))
    grams = F.transform(starts, lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(n)]))
    return with_once(df, **{name: F.array_distinct(grams)}).drop("_words")


def containment(part: Column, whole: Column) -> Column:
    """Share of the n-grams in ``part`` that ``whole`` has too; 0 if it has none."""
    shared = F.size(F.array_intersect(part, whole))
    return F.when(F.size(part) == 0, F.lit(0.0)).otherwise(shared / F.size(part))
