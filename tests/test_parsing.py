from conftest import package_frame, text_frame

from instrel.operators import parsing


def parsed(spark, *texts, mode="auto", **options):
    frame = parsing.parse_items(text_frame(spark, *texts), mode=mode, **options)
    return [r["items"] for r in frame.orderBy("id").collect()]


JSON_LIST = '[{"id":0,"label":"positive","neg_type":null,"confidence":0.95}]'
PYTHON_LIST = "[{'id':0,'label':'positive','neg_type':None,'passage':'It\\'s \"q\"','confidence':0.95}]"


def test_json_first_then_literal(spark):
    json_items, python_items = parsed(spark, JSON_LIST, PYTHON_LIST)
    assert json_items == [{"id": "0", "label": "positive", "neg_type": None, "confidence": "0.95"}]
    assert python_items[0]["passage"] == "It's \"q\"" and python_items[0]["neg_type"] is None


def test_modes_read_only_their_own_form(spark):
    assert parsed(spark, JSON_LIST, PYTHON_LIST, mode="json")[1] is None
    json_text, python_text = parsed(spark, JSON_LIST, PYTHON_LIST, mode="literal")
    assert json_text is None and python_text is not None


def test_single_object_is_a_list_of_one_only_for_literals(spark):
    single = '{"id":1,"label":"positive","confidence":0.4}'
    assert parsed(spark, single) == [None]
    assert parsed(spark, single, mode="literal") == [[{"id": "1", "label": "positive", "confidence": "0.4"}]]


def test_whole_package_fails_with_one_bad_member(spark):
    texts = ['[{"id":1', '[{"id":0}, 5]', '[{"id":0}, null]', "[{'id':0}, 5]", "", "nan", '[{"id":0}] x', '[{"id":0}]]']
    assert parsed(spark, *texts, None) == [None] * 9


def test_members_that_are_no_objects_can_be_dropped(spark):
    for text in ('[{"id":0}, 5, {"a":null}]', "[{'id':0}, 5, {'a':None}]"):
        assert parsed(spark, text, drop_non_dict=True) == [[{"id": "0"}, {"a": None}]]


def candidates(spark, text, scores="default"):
    frame = parsing.to_responses(parsing.parse_items(text_frame(spark, text)), scores)
    return [r.asDict() for r in parsing.explode_candidates(frame).orderBy("pos").collect()]


def test_defaults_only_for_absent_keys(spark):
    absent = candidates(spark, "[{}]")[0]
    assert (absent["item_id"], absent["title"], absent["passage"], absent["label"], absent["confidence"]) == (0, "", "", "", 0.0)
    assert absent["neg_type"] is None and absent["explanation"] is None
    null = candidates(spark, '[{"id":0,"title":null,"confidence":null}]')[0]
    assert null["title"] is None and null["confidence"] is None


def test_numeric_text_counts_as_score(spark):
    assert candidates(spark, '[{"confidence":" 0.4 "}]')[0]["confidence"] == 0.4
    assert candidates(spark, '[{"confidence":"0.4d"}]')[0]["confidence"] is None


def test_probe_takes_first_usable_key_and_keeps_it_on_its_item(spark):
    assert candidates(spark, '[{"score":"x","probability":0.2}]', "probe")[0]["confidence"] == 0.2
    rows = candidates(spark, '[{"id":0},{"id":1,"confidence":0.9}]', "probe")
    assert [(r["item_id"], r["confidence"]) for r in rows] == [(1, 0.9)]


def test_empty_package_has_no_candidates(spark):
    assert candidates(spark, "[]") == []


def test_kept_and_rejected_packages_are_all_packages(spark):
    frame = text_frame(
        spark, JSON_LIST, PYTHON_LIST, '[{"id":0}]', '[{"confidence":"x","label":"a"}]', '[{"confidence":1}]',
        "[", "[]", None, '[{"confidence":NaN,"label":"a"}]',
    )
    items = parsing.parse_items(frame)
    kept = {r["id"] for r in parsing.strict_packages(items).collect()}
    rejects = {int(r["id"]): r["reason"] for r in parsing.parse_rejects(items).collect()}
    assert kept == {0, 1, 6}
    assert rejects == {2: "no_confidence", 3: "no_confidence", 4: "no_label", 5: "bad_package", 7: "bad_package",
                       8: "no_confidence"}


def test_explode_keeps_positions(spark):
    rows = parsing.explode_candidates(package_frame(spark, [("a", 0.1), ("b", 0.2)], [])).collect()
    assert sorted((r["id"], r["pos"], r["label"]) for r in rows) == [(0, 0, "a"), (0, 1, "b")]


def test_strict_json_takes_whole_texts_only_and_the_last_of_a_key(spark):
    from pyspark.sql import functions as F

    from instrel.functions.json_text import json_items, json_object, json_value

    texts = ['{"a":"x"}', '{"a":"x"},{}] junk', '[{"id":1}],[]] junk', '[{"id":1}]', '{"a":"1","b":"2","a":"3"}', '{"a":"end of text 5f0c2d81"}', "{}",
             '{"a":1},{"end of text 5f0c2d81":"1"}] junk', "5", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r for r in frame.select("i", json_object(F.col("t")).alias("o"), json_items(F.col("t")).alias("l"), json_value(F.col("t")).alias("v")).collect()}
    assert [i for i in got if got[i]["o"] is not None] == [0, 4, 5, 6]
    assert got[4]["o"] == {"a": "3", "b": "2"}
    assert [i for i in got if got[i]["l"] is not None] == [3]
    assert [i for i in got if got[i]["v"] is not None] == [0, 3, 4, 5, 6, 8]
