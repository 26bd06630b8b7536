"""Some fields of a nested array, so that a scan reads only those.

A lambda over whole structs, or ``explode`` of them, makes the scan read every
nested field, long texts included. Field arrays (``responses.label``) are pruned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def members(array: str, *fields: str) -> Column:
    """``array<struct>`` of only the given fields of an ``array<struct>`` column."""
    return F.arrays_zip(*[F.col(f"{array}.{field}") for field in fields])
