from types import SimpleNamespace

import pytest
from conftest import package_frame, text_frame

from instrel.constants import PACKAGE_COLUMNS
from instrel.operators import parsing
from instrel.plans.flows import Prompts
from instrel.session import shared_dir
from instrel.sources import tables
from instrel.streaming import ingest

QA = "id bigint, question string, answer string, chunk string"


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def test_qa_csv_missing_texts_and_quotes(spark, folder):
    with open(f"{folder}/qa.csv", "w") as f:
        f.write('ID,Question,Answer,Keywords,extra\n7,"a ""b""\nc",NA,k,x\nnan,None,"",k,x\n')
    qa = tables.read_qa(spark, f"{folder}/qa.csv")
    assert [tuple(r) for r in qa.select("id", "question", "answer").collect()] == [("7", 'a "b"\nc', None), (None, None, None)]
    assert tables.drop_metadata(qa).columns == ["id", "question", "answer"]
    assert tables.drop_metadata(qa, keep_id=False).columns == ["question", "answer"]


def test_qa_csv_needs_its_columns(spark, folder):
    with open(f"{folder}/qa.csv", "w") as f:
        f.write("ID,Question\n1,q\n")
    with pytest.raises(ValueError):
        tables.read_qa(spark, f"{folder}/qa.csv")


def test_package_csv_is_named_by_position(spark, folder):
    texts = text_frame(spark, "[{'passage': 'a, \"b\"\\nc', 'confidence': 1}]").selectExpr(
        "id as a", "'q' as b", "'o' as c", "'i\nj' as d", "response as e"
    )
    tables.write_csv(texts, f"{folder}/p")
    read = tables.read_packages(spark, f"{folder}/p")
    assert read.columns == PACKAGE_COLUMNS
    row = read.first()
    assert row["Instruction"] == "i\nj"
    parsed = parsing.parse_items(read.selectExpr("ID as id", "0 as choice_index", "Response as response")).first()
    assert parsed["items"][0]["passage"] == 'a, "b"\nc'


def test_package_csv_with_other_width_is_refused(spark, folder):
    tables.write_csv(spark.createDataFrame([("a", "b")], "a string, b string"), f"{folder}/p")
    with pytest.raises(ValueError):
        tables.read_packages(spark, f"{folder}/p")


def test_append_and_replace(spark, folder):
    packages = package_frame(spark, [("positive", 0.5)], [])
    progress = tables.append_packages(packages, f"{folder}/t")
    assert progress["rows"] == 2 and progress["rows_per_second"] > 0
    tables.append_packages(packages, f"{folder}/t")
    assert tables.read_package_parquet(spark, f"{folder}/t").count() == 4
    tables.write_filtered(packages, f"{folder}/f")
    tables.write_filtered(packages, f"{folder}/f")
    assert spark.read.parquet(f"{folder}/f").count() == 2
    tables.csv_to_parquet(packages, f"{folder}/c", 2)
    assert spark.read.parquet(f"{folder}/c").count() == 2


def test_restarted_stream_repeats_nothing_and_takes_new_files(spark, folder):
    prompts = Prompts(model="m")
    qa, out, progress = f"{folder}/qa", f"{folder}/out", f"{folder}/progress"

    def add(*ids):
        rows = [(i, f"q{i}", f"a{i}" if i else None, None) for i in ids]
        spark.createDataFrame(rows, QA).repartition(2).write.mode("append").parquet(qa)

    def run():
        return ingest.run_requests(spark, qa, out, progress, prompts, max_files=1)["rows"]

    add(0, 1, 2, 3)
    assert run() == 3  # input 0 has no answer
    assert run() == 0
    add(4)
    assert run() == 1
    written = ingest.read_requests(spark, out)
    assert sorted(r["id"] for r in written.collect()) == [1, 2, 3, 4]


def test_shared_folder_is_the_one_the_session_names(folder):
    session = SimpleNamespace(conf={"spark.checkpoint.dir": folder})
    first, second = shared_dir(session, "x"), shared_dir(session, "x")
    assert first.startswith(f"{folder}/x-") and first != second


def test_a_cluster_must_name_its_shared_folder():
    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        shared_dir(session, "x")
