"""Prompt templates with ``{{name}}`` holes, rendered as one concat per row.

A value that itself contains a hole stays as it is: pieces are concatenated,
never replaced one after the other.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOLE = re.compile(r"\{\{\s*(\w+)\s*\}\}")
_TEMPLATES = Path(__file__).resolve().parent.parent / "templates"


def load_template(path: str | Path) -> str:
    """Template text from a file; a bare name means one of the templates shipped here."""
    path = Path(path)
    if not path.suffix:
        path = _TEMPLATES / f"{path}.txt"
    return path.read_text(encoding="utf-8")


def template_pieces(template: str) -> list[tuple[str, str]]:
    """("text", literal) and ("hole", name) pieces in order.

    One newline at the very end is left out, as template engines do.
    """
    if "{%" in template or "{#" in template:
        raise ValueError("only {{name}} holes are supported")
    template = template.replace("\r\n", "\n").removesuffix("\n")
    pieces = []
    for i, part in enumerate(_HOLE.split(template)):
        if part:
            pieces.append(("hole" if i % 2 else "text", part))
    return pieces


def render(template: str, values: dict[str, Column]) -> Column:
    """Fill the holes; a hole without a value, or with a NULL value, is empty."""
    columns = []
    for kind, part in template_pieces(template):
        if kind == "text":
            columns.append(F.lit(part))
        elif part in values:
            columns.append(F.coalesce(values[part].cast("string"), F.lit("")))
    return F.concat(*columns) if columns else F.lit("")
