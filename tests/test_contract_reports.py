from conftest import package_frame

from instrel.operators import contract, parsing, reports


def response(label, **fields):
    base = {"label": label, "confidence": 0.5}
    if label == "positive":
        base |= {"why_relevant": "w"}
    else:
        base |= {"neg_type": "omission", "explanation": "e"}
    return base | fields


def rows(frame):
    return [r.asDict() for r in frame.orderBy("id").collect()]


def test_counts_are_a_parameter(spark):
    packages = package_frame(spark, [("positive", 1)] + [("negative", 0)] * 6, [("positive", 1)] * 2)
    assert [r["ok"] for r in rows(contract.check_counts(packages))] == [False, False]
    assert [r["ok"] for r in rows(contract.check_counts(packages, 5, 6))] == [True, False]


def test_word_bounds_are_closed(spark):
    sizes = {"positive": (79, 80, 150, 151), "negative": (59, 60, 140, 141)}
    packages = package_frame(
        spark, *[[{"label": label, "passage": " \n" + "w \t" * n} for n in sizes[label]] for label in sizes],
        [{"label": "other", "passage": "w"}],
    )
    checked = contract.check_word_length(parsing.explode_candidates(packages)).orderBy("id", "pos").collect()
    assert [r["ok"] for r in checked] == [False, True, True, False] * 2 + [None]
    assert checked[1]["words"] == 80
    totals = contract.violations(contract.check_word_length(parsing.explode_candidates(packages)), "ok").first()
    assert (totals["rule"], totals["violations"], totals["checked"]) == ("ok", 4, 8)


def test_failure_modes_known_and_distinct(spark):
    modes = ["omission", "partial_answer", "outdated_info", "unsupported_inference"]
    good = [response("negative", neg_type=m) for m in modes + ["omission", None]]
    packages = package_frame(spark, good, good + [response("negative", neg_type="new")])
    checked = rows(contract.check_failure_modes(packages))
    assert [(r["distinct_modes"], r["unknown_modes"], r["ok"]) for r in checked] == [(4, 0, True), (4, 1, False)]


def test_field_rules(spark):
    package = [
        response("positive", neg_type="omission", why_relevant=None), response("negative", neg_type=None),
        response("negative", why_relevant="w"), response("negative", explanation=None),
        response("negative", confidence=1.1), response("negative", confidence=float("nan")),
        response("negative", confidence=None), response("positive"), response("other"),
    ]
    row = rows(contract.check_fields(package_frame(spark, package)))[0]
    assert row == {
        "id": 0, "choice_index": 0, "bad_confidence": 3, "positive_with_neg_type": 1, "positive_without_why": 1,
        "negative_without_neg_type": 1, "negative_with_why": 1, "negative_without_explanation": 1,
    }


def test_evidence_must_be_a_chunk_of_its_package(spark):
    packages = package_frame(spark, [response("positive", evidence=["a", "z", "z"])], [response("positive", evidence=["a"])])
    chunks = spark.createDataFrame([(0, "a"), (1, "b")], "id bigint, chunk_id string")
    found = rows(contract.check_evidence(packages, chunks))
    assert [(r["id"], r["chunk_id"], r["citations"]) for r in found] == [(0, "z", 2), (1, "a", 1)]


def test_answer_leaks(spark):
    packages = package_frame(spark, [], instruction="x")
    frame = packages.selectExpr(
        "id", "choice_index", "'Must say: the ANSWER is forty-two!' as instruction", "'The answer is forty two.' as og_positive"
    )
    row = rows(contract.check_answer_leak(frame))[0]
    assert row["verbatim"] and row["leaks"] and row["overlap"] == 1.0
    near = frame.selectExpr(
        "id", "choice_index", "instruction", "'so the answer is forty two or more' as og_positive"
    )
    row = rows(contract.check_answer_leak(near))[0]
    assert not row["verbatim"] and row["overlap"] == 0.5 and row["leaks"]
    short = frame.selectExpr("id", "choice_index", "instruction", "'no' as og_positive")
    assert rows(contract.check_answer_leak(short))[0]["overlap"] == 0.0


def test_doc_partition(spark):
    texts = [
        '{"relevant_docs":[1],"non_relevant_docs":[2]}', '{"relevant_docs":[],"non_relevant_docs":[2]}',
        '{"relevant_docs":[1],"non_relevant_docs":[1]}', '{"relevant_docs":[1]}', "x",
    ]
    frame = spark.createDataFrame([(str(i), 0, t) for i, t in enumerate(texts)], "request_id string, choice_index int, content string")
    checked = contract.check_doc_partition(frame).orderBy("request_id").collect()
    assert [(r["has_lists"], r["has_relevant"], r["disjoint"]) for r in checked] == [
        (True, True, True), (True, False, True), (True, True, False), (False, True, False), (False, False, False)
    ]


def test_training_pairs_are_linear_and_use_every_passage(spark):
    one = package_frame(spark, [response("positive")] + [response("negative")] * 5)
    assert [r["negative"] for r in reports.training_pairs(one).orderBy("row").collect()] == ["p1", "p2", "p3", "p4", "p5"]
    many = package_frame(spark, [response("positive")] * 3 + [response("negative")] * 4, [response("positive")])
    pairs = reports.training_pairs(many).collect()
    assert len(pairs) == 4
    assert {r["positive"] for r in pairs} == {"p0", "p1", "p2"} and {r["negative"] for r in pairs} == {"p3", "p4", "p5", "p6"}


def test_coverage_names_every_cell(spark):
    frame = spark.createDataFrame([("persona", "short"), ("persona", "long")], "style string, length string")
    cells = {(r["style"], r["length"]): r["n"] for r in reports.variant_coverage(frame).collect()}
    assert len(cells) == 25 and cells["all", "all"] == 2 and cells["persona", "all"] == 2
    assert cells["generic", "very long"] == 0


def test_dataset_counts(spark):
    packages = package_frame(spark, [("positive", 1), ("x", 0)], [])
    assert tuple(reports.dataset_counts(packages.union(packages)).first()) == (2, 4, 4, 2, 2)


def test_an_answer_leaks_as_whole_words_only(spark):
    frame = spark.createDataFrame([(1, 0, "state what is known", "no"), (2, 0, "say no to it", "no")], "id int, choice_index int, instruction string, og_positive string")
    assert {r["id"]: r["verbatim"] for r in contract.check_answer_leak(frame).collect()} == {1: False, 2: True}


def test_unpaired_packages_are_reported(spark):
    packages = package_frame(spark, [("positive", 0.5)], [("positive", 0.5), ("negative", 0.5)], [])
    found = {r["id"]: (r["has_positive"], r["has_negative"]) for r in reports.unpaired_packages(packages).collect()}
    assert found == {0: (True, False), 2: (False, False)}
