"""Reproducible choice of instruction style and length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform_choice(key: Column, salt: str, options: list[str]) -> Column:
    """One of ``options`` by a hash of key and salt: the same row always gets the same one."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(salt)))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.element_at(
        F.array(*[F.lit(option) for option in options]),
        (number % len(options)).cast("int") + 1,
    )
