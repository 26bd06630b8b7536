"""Evaluate a costly column once per row.

The optimizer moves filters below the projection they refer to and writes the
projected expression out again for each use. A one-element generator keeps a
parsed value as a column that later filters and fields only refer to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns, each evaluated once per row however often it is used."""
    for name, column in columns.items():
        kept = [F.col(c) for c in df.columns if c != name]
        df = df.select(*kept, F.explode(F.array(column)).alias(name))
    return df
