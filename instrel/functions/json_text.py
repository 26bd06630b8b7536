"""Strict reading of JSON text with Spark's own parser.

``from_json`` stops at the end of the first value and ignores what follows. To
accept a text only if all of it is one JSON value, it is parsed as the first
element of an array that must hold exactly that value and an end mark. A text
that closes the array itself cannot supply the mark, which is the text's own
digest. Of a repeated key the last value counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from instrel.schemas import RAW_ITEMS

STRICT = {"allowSingleQuotes": "false"}


def _whole(text: Column, element_type: str, end: Column, marked) -> Column:
    """The value of ``element_type`` if ``text`` is that alone; ``end``: what is put behind it, found again by ``marked``."""
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit(","), end, F.lit("]")), f"array<{element_type}>", STRICT)
    ended = (F.size(parsed) == 2) & F.coalesce(marked(F.get(parsed, F.lit(1))), F.lit(False))
    return F.when(ended, F.get(parsed, F.lit(0)))


def _end_object(text: Column) -> Column:
    return F.concat(F.lit('{"'), F.md5(text), F.lit('":"1"}'))


def _repeats(fields: Column) -> Column:
    return F.size(F.array_distinct(F.map_keys(fields))) < F.size(fields)


def last_wins(fields: Column) -> Column:
    """The map with the last value of a key that was given several times."""
    keys, values = F.reverse(F.map_keys(fields)), F.reverse(F.map_values(fields))
    once = F.array_distinct(keys)
    rebuilt = F.map_from_arrays(once, F.transform(once, lambda k: F.get(values, F.array_position(keys, k).cast("int") - 1)))
    return F.when(_repeats(fields), rebuilt).otherwise(fields)


def json_value(text: Column) -> Column:
    """JSON text of the value if ``text`` is exactly one JSON value, else NULL."""
    return _whole(text, "string", _end_object(text), lambda end: end == _end_object(text))


def raw_items(text: Column, drop_non_dict: bool = False) -> Column:
    """The members of a JSON list, as ``plain_items`` takes them; NULL if ``text`` is no list, or holds more than objects and nulls.

    With ``drop_non_dict`` other list elements are left out instead.
    """
    end = F.concat(F.lit("["), _end_object(text), F.lit("]"))
    if drop_non_dict:
        members = F.transform(
            _whole(text, "array<string>", end, lambda found: F.get(found, F.lit(0)) == _end_object(text)), json_fields)
        return F.filter(members, lambda item: item.isNotNull())
    return _whole(text, RAW_ITEMS, end, lambda found: F.map_contains_key(F.get(found, F.lit(0)), F.md5(text)))


def plain_items(items: Column) -> Column:
    """Raw items as they count: NULL if a member is null, and of a repeated key the last value."""
    kept = F.when(F.exists(items, _repeats), F.transform(items, last_wins)).otherwise(items)
    return F.when(F.forall(items, lambda item: item.isNotNull()), kept)


def json_items(text: Column, drop_non_dict: bool = False) -> Column:
    """``array<map<string,string>>`` if ``text`` is a JSON list of objects, else NULL."""
    return plain_items(raw_items(text, drop_non_dict))


def json_object(text: Column) -> Column:
    """``map<string,string>`` of the members if ``text`` is exactly one JSON object, else NULL."""
    return last_wins(_whole(text, "map<string,string>", _end_object(text), lambda end: F.map_contains_key(end, F.md5(text))))


def json_fields(text: Column) -> Column:
    """Members of a value known to be JSON, NULL if it is no object."""
    return last_wins(F.from_json(text, "map<string,string>", STRICT))


def is_json_list(text: Column) -> Column:
    return F.ltrim(text).startswith("[")
