"""Python literals: read by column functions where these are sure, by Python elsewhere, always as Python reads them."""

import ast
import json
import re

import pytest
from conftest import text_frame
from pyspark.sql import functions as F

from instrel.operators import parsing
from instrel.plans import derived

JSON_LIST = '[{"id":0,"label":"positive","neg_type":null,"confidence":0.95}]'
PYTHON_LIST = "[{'id':0,'label':'positive','neg_type':None,'passage':'It\\'s \"q\"','confidence':0.95}]"

TEXTS = [
    PYTHON_LIST, "[]", "[{}]", " [{'a': 1}]", "[{'a': 1}]\n", "{'id': 1}", "{'id': 1}, {'id': 2}", "[{'id': 1,}]", "({'id': 1},)",
    "[{'a': 'x' 'y'}]", r"""[{'a': 'it\'s', 'b': "it's \" q", 'c': 'say "x"', 'd': '\\', 'e': '\\\'', 'f': 'a\\"b', 'g': "a\\\"b'"}]""",
    r"""[{'a': '\xe9\u00e9\n\t\r\b\f', 'b': '\\xe9', 'c': '\\\xe9', 'd': '""'}]""", r"[{'a': '\N{BULLET}', 'b': '\101', 'c': '\q', 'd': '\/', 'e': '\v'}]",
    "[{'a': '\t'}]", "[{'a': 'é日😀'}]", "[{'a': b'x'}]", "[{'a': r'x'}]", "[{'a': 0.95, 'b': 1, 'c': -1.5, 'd': 0, 'e': 100.0, 'f': -7}]",
    "[{'a': 0.90, 'b': 1e5, 'c': 0.00001, 'd': 1_0, 'e': +1, 'f': -0, 'g': -0.0, 'h': 1.}]", "[{'a': 0.90}]", "[{'a': 0.0001}, {'a': 0.00012}, {'a': 0.00001}]",
    "[{'a': 0x10}]", "[{'a': 1j}]", "[{'a': None, 'b': True, 'c': False}]", "[{'a': null}]", "[{'a': true}]", "[{'a': Nonex}]", "[{'a': 05}]", "[{1: 'a'}]",
    "[{'a': [1, {'b': 'c'}], 'd': ()}]", "[{'a': {'x'}}]", "[{'a': 1, 'a': 2}]", "[{'a': 1} {'b': 2}]", "[{'a': 1}]]", "[{'a': 1}, 5]", "[{'a': 1}, None]",
    "# x\n[{'a': 1}]", "[{'a': 1}] # x", "[{'a': '''x'''}]", "[{'a': ''}, {'b': \"\"}]", "[{'a': 'x\ny'}]", "'text'", "5", "nan", "", "[", "[{'a': '\x00'}]",
    "[{'a': 0.123456}, {'a': 123456789.123456}]", "{'a': 1}]", "[{'a': 1}", "{}", "{},{}", "[[{'a': 1}]]", "{'a'}",
]


def plain(value):
    """A member's value as the text that a string column shows."""
    return value if value is None or isinstance(value, str) else json.dumps(value, separators=(",", ":"))


def spelled(items):
    """Numbers with a fraction or an exponent in one spelling."""
    one = lambda v: repr(float(v)) if re.fullmatch(r"-?[0-9]+(\.[0-9]+)?([eE]-?[0-9]+)?", v or "") and not v.isdigit() else v
    return items and [{k: one(v) for k, v in item.items()} for item in items]


def by_python(text, drop):
    try:
        value = ast.literal_eval(text)
        value = value if isinstance(value, list) else [value]
        value = json.loads(json.dumps([v for v in value if isinstance(v, dict) or not drop]))
    except (ValueError, SyntaxError, TypeError):
        return None
    if not all(isinstance(v, dict) for v in value):
        return None
    return [{k: plain(x) for k, x in v.items()} for v in value]


def parsed(spark, *texts, **options):
    frame = parsing.parse_items(text_frame(spark, *texts), **options)
    return [r["items"] for r in frame.orderBy("id").collect()]


@pytest.mark.parametrize("drop", [False, True])
def test_read_as_python_reads_them(spark, drop):
    got = parsed(spark, *TEXTS, mode="literal", drop_non_dict=drop)
    for text, items in zip(TEXTS, got, strict=True):
        assert spelled(items) == spelled(by_python(text, drop)), text


def test_python_sees_only_what_columns_do_not_read(spark, monkeypatch):
    """With a Python function that reads nothing, what is read was read by column functions."""
    monkeypatch.setattr(parsing, "literal_as_json", lambda **_: lambda rest: F.lit(None).cast("string"))
    texts = [JSON_LIST, PYTHON_LIST, "[]", "[{'a': None, 'b': 0.5, 'c': \"it's\"}]", "[{'a': 0.50}]", "({'a': 1},)"]
    assert [x is not None for x in parsed(spark, *texts)] == [True, True, True, True, False, False]
    assert [x is not None for x in parsed(spark, *texts, mode="literal")] == [False, True, True, True, False, False]


def test_of_the_given_packages_only_broken_ones_go_to_python(spark, sf, monkeypatch):
    monkeypatch.setattr(parsing, "literal_as_json", lambda **_: lambda rest: F.when(rest.isNotNull(), F.lit('[{"sent":1}]')))
    texts = derived.package_text(spark, sf)
    sent = parsing.parse_items(texts).where("get(items, 0)['sent'] = 1").select("id")
    broken = texts.where("id % 17 = 3 or id % 19 = 5 or id % 13 = 6").select("id")
    assert 0 < sent.count() < 0.3 * texts.count()
    assert sent.exceptAll(broken).count() == 0
