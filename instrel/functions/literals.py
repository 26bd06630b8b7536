"""Python-literal package text as JSON text.

Most literals are the ``repr`` of lists of dictionaries of texts and numbers. They
are cut into tokens by one pattern, inside Spark, and each token is spelled anew.
The pattern takes only what is written the same, or in one certain other way, in
JSON: strings with the escapes both know, numbers as ``repr`` writes them, names
and brackets. A text that holds anything else, or does not make JSON when it is
spelled anew, goes to a Python function; it gets NULL for all other rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_ESCAPE = r"""\\(?:[\\'"nrtbf]|x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4})"""
_STRING = "|".join(rf"{q}[^{q}\\\n\r]*+(?:{_ESCAPE}[^{q}\\\n\r]*+)*+{q}" for q in ("'", '"'))
# At most 15 digits, no trailing zeros and no more than three zeros behind the point: as ``repr`` gives them back.
_NUMBER = r"-?(?:0|[1-9][0-9]{0,8})\.(?:0|(?!0000)[0-9]{0,5}[1-9])(?![0-9eE_.jJ])|(?:0|-?[1-9][0-9]{0,17})(?![0-9eE_.jJxXoObB])"
_TOKEN = rf"{_STRING}|None|True|False|{_NUMBER}|[\[\]{{}},: \n\t]++"
_ENDS = r"\A[\[{](?s:.*)[\]}]\z"

# An odd number of backslashes makes an escape, an even number is so many pairs.
_PAIRS = r"(?<!\\)((?:\\\\)*+)"


def _respelled(token: Column) -> Column:
    """A token in JSON. Strings change only where the two notations differ."""
    body = F.substring(token, F.lit(2), F.length(token) - 2)
    body = F.regexp_replace(body, rf"{_PAIRS}\\'", "$1'")
    body = F.regexp_replace(body, rf"{_PAIRS}\\x([0-9a-fA-F]{{2}})", r"$1\\u00$2")
    body = F.when(F.startswith(token, F.lit("'")), F.regexp_replace(body, rf'{_PAIRS}"', r'$1\\"')).otherwise(body)
    plain = F.startswith(token, F.lit("'")) & ~F.contains(token, F.lit("\\")) & ~F.contains(token, F.lit('"'))
    quoted = F.startswith(token, F.lit("'")) | F.startswith(token, F.lit('"'))
    return (
        F.when(plain, F.translate(token, "'", '"'))
        .when(quoted, F.concat(F.lit('"'), body, F.lit('"')))
        .when(token == "None", "null").when(token == "True", "true").when(token == "False", "false")
        .otherwise(token)
    )


def literal_tokens(text: Column) -> Column:
    """Tokens of a text that is made of nothing else, else NULL."""
    tokens = F.regexp_extract_all(F.when(text.rlike(_ENDS), text), F.lit(_TOKEN), F.lit(0))
    length = F.aggregate(tokens, F.lit(0), lambda so_far, t: so_far + F.length(t))
    return F.when(length == F.length(text), tokens)


def tokens_as_json(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, _respelled), "")


def literal_as_json(wrap_single: bool = False, drop_non_dict: bool = False):
    """Arrow function: Python literal text -> JSON text of a list, or NULL.

    ``wrap_single`` turns a single value into a one-element list,
    ``drop_non_dict`` leaves out list elements that are not dictionaries.
    All it needs is inside, so executors need no copy of this package.
    """

    def to_json(text):
        import ast
        import json

        if text is None:
            return None
        try:
            value = ast.literal_eval(text)
            if wrap_single and not isinstance(value, list):
                value = [value]
            if not isinstance(value, list):
                return None
            if drop_non_dict:
                value = [item for item in value if isinstance(item, dict)]
            return json.dumps(value)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    @F.pandas_udf("string")
    def convert(texts: pd.Series) -> pd.Series:
        return texts.map(to_json)

    return convert
