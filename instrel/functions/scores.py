"""Scores and labels of a single passage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from instrel.constants import NEGATIVE, POSITIVE, SCORE_KEYS


def try_score(value: Column) -> Column:
    """Number from a number or a numeric text, NULL if it is neither.

    The cast alone would also take Java's suffixes and hexadecimals (``0.4d``).
    """
    text = F.trim(value)
    return F.when(~text.rlike(r"(?i)[0-9.][df]$|0x"), text.try_cast("double"))


def probe_score(item: Column) -> Column:
    """First of the known score keys whose value is a number."""
    return F.coalesce(*[try_score(item[key]) for key in SCORE_KEYS])


def label_class(label: Column) -> Column:
    """``positive`` only for exactly that label, everything else is ``negative``."""
    return F.when(label == POSITIVE, F.lit(POSITIVE)).otherwise(F.lit(NEGATIVE))


def is_score(value: Column) -> Column:
    """True for a finite number: neither NULL nor NaN nor infinite."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
