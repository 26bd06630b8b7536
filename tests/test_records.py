"""CSV records cut by many tasks against Spark's reader of whole files and Python's csv."""

import csv
import io
import random

import pytest

from instrel.sources import records, tables

OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


@pytest.fixture()
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield put
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def odd_rows(n, seed):
    rng = random.Random(seed)
    some = ['"', '""', ",", "\n", "\n\n", "\r\n", "a", "word ", "é", "x" * 30, '","', '"\n"', " "]
    return [[f"{i}", *("".join(rng.choice(some) for _ in range(rng.randrange(12))) for _ in range(2))] for i in range(n)]


def text_of(rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    return out.getvalue()


def write(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


@pytest.mark.parametrize("size", [300, 10**6])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_as_one_task(spark, tmp_path, small_blocks, size, end):
    path = str(tmp_path / "t.csv")
    rows = odd_rows(90, size)
    write(path, text_of([["ID", "Question", "Answer"], *rows], end))
    small_blocks(size)
    if size < 10**6:
        assert records.blocks(records._lines(spark, path)).count() > 10
    got = tables.read_csv(spark, path)
    if end == "\n":  # Where records end with "\r\n", Spark's reader takes the carriage returns out of fields too.
        assert sorted(map(tuple, got.select("ID", "Question", "Answer").collect()), key=str) == sorted(
            map(tuple, spark.read.options(**OPTIONS).csv(path).select("ID", "Question", "Answer").collect()), key=str)
    assert got.where("_bad_record is not null").count() == 0
    plain = lambda *row: tuple(x or "" for x in row)
    assert sorted(plain(*r) for r in rows) == sorted(plain(r.ID, r.Question, r.Answer) for r in got.collect())


@pytest.mark.parametrize("size", [40, 10**6])
def test_quotes_in_unquoted_fields_and_text_behind_quotes(spark, tmp_path, small_blocks, size):
    path = str(tmp_path / "t.csv")
    write(path, 'ID,Question,Answer\n1,5" pipe,a\n2,say "x,y" z,b\n\n3,"q"tail,c\n4,"line\nend",d"\n5, "p",""\n6,"",e\n7,"a ""b""\n\n c",f\n\n')
    small_blocks(size)
    columns = ("ID", "Question", "Answer")
    got = tables.read_csv(spark, path)
    good = got.where("_bad_record is null")
    assert [r[0] for r in rows_of(good, "ID")] == ["1", "3", "4", "5", "6", "7"]
    spark_rows = {r.ID: tuple(r) for r in spark.read.options(**OPTIONS).csv(path).select(*columns).collect()}
    assert all(spark_rows[r[0]] == r for r in rows_of(good, *columns))
    assert [tuple(r) for r in tables.rejects_of(got).select("id", "raw").collect()] == [("2", '2,say "x,y" z,b')]


def test_a_quote_that_is_never_closed(spark, tmp_path, small_blocks, monkeypatch):
    path = str(tmp_path / "t.csv")
    write(path, "ID,Question,Answer\n1,a,b\n2,\"open,c\n" + "3,x,y\n" * 20)
    small_blocks(50)
    assert tables.read_csv(spark, path).count() == 2
    monkeypatch.setattr(records, "LONGEST", 60)
    monkeypatch.setattr(records, "SHOWN", 10)
    found = tables.read_csv(spark, path)
    assert [tuple(r) for r in tables.rejects_of(found).select("raw").collect()] == [('2,"open,c\n',)]
    assert found.count() == 2 and tables.qa_of(found).count() == 1


def test_a_record_over_many_blocks(spark, tmp_path, small_blocks):
    path = str(tmp_path / "t.csv")
    long = "\n".join(f"line {i}, with a comma" for i in range(60))
    write(path, text_of([["ID", "Question", "Answer"], ["1", long, "a"], ["2", "q", long]]))
    small_blocks(150)
    assert rows_of(tables.read_qa(spark, path), "id", "question", "answer") == [("1", long, "a"), ("2", "q", long)]


def test_counts_and_single_columns(spark, tmp_path):
    folder = tmp_path / "c"
    folder.mkdir()
    write(folder / "a.csv", "ID,Question,Answer\n1,a,b\n2,c\n")
    write(folder / "b.csv", "﻿Answer,ID,Question\nb,3,a\nb,4,a,more\n")
    path = str(folder)
    assert tables.read_qa(spark, path).count() == 2
    assert rows_of(tables.read_qa(spark, path), "answer") == [("b",), ("b",)]
    assert tables.csv_rejects(spark, path).count() == 2
    assert rows_of(tables.csv_rejects(spark, path), "raw") == [("2,c",), ("b,4,a,more",)]
    assert rows_of(tables.csv_rejects(spark, path), "id") == [("2",), ("4",)]
    write(tmp_path / "p.csv", "a,b,c,d,e\n1,q,o,i,r\n1,q,o,i,s\n1,q,o,i,s\n")
    packages = tables.read_packages(spark, str(tmp_path / "p.csv"))
    assert packages.count() == 3 and rows_of(packages, "Response") == [("r",), ("s",), ("s",)]
    numbered = tables.package_rows(packages)
    assert numbered.count() == 3 and rows_of(numbered, "choice_index") == [(0,), (1,), (2,)]
    again = tables.package_rows(packages.repartition(3))
    assert rows_of(numbered, "choice_index", "response") == rows_of(again, "choice_index", "response")


def test_no_file_and_repeated_columns(spark, tmp_path):
    (tmp_path / "e").mkdir()
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "e"))
    write(tmp_path / "r.csv", "ID,ID\n1,2\n")
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path / "r.csv"))


def test_the_id_of_a_reject_does_not_depend_on_file_names(spark, sf):
    from instrel.plans import catalog

    first = sorted(map(str, catalog.csv_rejects(spark, sf).collect()))
    for _ in range(3):
        assert sorted(map(str, catalog.csv_rejects(spark, sf).collect())) == first
    assert "id='a'" not in str(first)
