"""Readers, writers and the stream on small files."""

import json

import pytest

from pyspark.sql import functions as F

from textloom.plans import reports
from textloom.sources import readers as R
from textloom.sources import writers as W
from textloom.streaming import features as T


def test_decoding_cascade(spark, tmp_path):
    folder = tmp_path / "cards" / "000001" / "files" / "12_ruby"
    folder.mkdir(parents=True)
    (folder / "a.txt").write_bytes("題\r\n作者\r\n\r\n本文①です。".encode("cp932"))
    (tmp_path / "cards" / "000001" / "files" / "13_x").mkdir()
    (tmp_path / "cards" / "000001" / "files" / "13_x" / "b.txt").write_bytes("題\n\n🙂".encode())
    rows = R.build_catalog(spark, str(tmp_path / "cards")).collect()
    assert [(r.work_id, r.person_id, r.title, r.author) for r in rows] == [("12", "000001", "題", "作者"), ("13", "000001", "題", "")]
    body = R.works(R.raw_texts(spark, str(tmp_path / "cards"))).filter("title = '題' and author = '作者'").first().body
    assert body == "\n本文①です。\n".lstrip("\n")


def test_catalog_scan_search_and_lookup(spark, tmp_path):
    path = tmp_path / "catalog.tsv"
    path.write_text("work_id\tperson_id\ttitle\tsubtitle\tauthor\tpath\n000127\t000879\tＡＢＣ\t\t作者\tp\nbad\tline\n9\t1\tabc\t\t別\tq\n", encoding="utf-8")
    catalog = R.catalog(spark, str(path))
    assert catalog.count() == 2
    assert [r.work_id for r in R.search(catalog, "abc").collect()] == ["9", "000127"]
    found = R.find_works(catalog, spark.createDataFrame([("127",), ("5",)], "work_id string")).collect()
    assert {r.wanted: r.title for r in found} == {"127": "ＡＢＣ", "5": None}


def test_analyses_keep_digit_folders(spark, tmp_path):
    for folder, author in (("000879", "b"), ("chapters", "x"), ("000035", "a")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "1.json").write_text(json.dumps({"work_id": "1", "author": author, "title": "t", "stats": {"characters": 5}}), encoding="utf-8")
    rows = R.analyses(spark, str(tmp_path / "*" / "*.json")).collect()
    assert [(r.author, r.stats.characters) for r in rows] == [("a", 5), ("b", 5)]


def test_writers_and_reports(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 2, 3.0, 0.5), ("b", 2, 3, 4.0, 0.25)], "author string, works int, characters int, sentence_length_mean double, dialogue_ratio double")
    W.features(rows, str(tmp_path / "f"), by="author")
    assert spark.read.parquet(str(tmp_path / "f")).filter("author = 'b'").first().works == 2
    page = reports.index_page(rows)
    assert "| a | 1 | 2 | 3.0 | 0.500 |" in page
    W.report(page + "\n\n", str(tmp_path / "r"), rows)
    assert spark.read.text(str(tmp_path / "r"), wholetext=True).first()[0].endswith("0.250 |\n")


def test_stream_of_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "あ。い！", "ja", "s", 4)], T.DOCUMENTS)
    docs.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # a restart reads nothing twice
        T.store(T.statistics(T.arriving(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("doc_id", "sentences", F.col("exclaim_per_1000")).collect()
    assert [tuple(r) for r in got] == [(1, 2, 250.0)]


def test_texts_meet_the_works_of_their_folders(spark, tmp_path):
    for folder in ("127_rashomon", "127", "1270_x", "9_y"):
        (tmp_path / "lib" / "p" / folder).mkdir(parents=True)
        (tmp_path / "lib" / "p" / folder / "plain.txt").write_text(folder, encoding="utf-8")
    root = str(tmp_path / "lib")
    assert sorted(r.raw for r in R.raw_texts(spark, R.work_files(root, "plain.txt", "127")).collect()) == ["127", "127_rashomon"]
    with pytest.raises(ValueError):
        R.work_files(root, "plain.txt", "*")
    meta = spark.createDataFrame([("127", "羅生門", "m"), ("9", "y", "m"), ("8", "none", "m"), (None, "null", "m")], "work_id string, title string, raw string")
    got = R.with_meta(R.raw_texts(spark, R.work_files(root, "plain.txt")), meta).collect()
    assert sorted((r.raw, r.title) for r in got) == [("127", "羅生門"), ("127_rashomon", "羅生門"), ("9_y", "y")]


def test_orders_of_analyses(spark, tmp_path):
    for folder, author, chars, length in (("000002", "a", 5, 9.0), ("000001", "b", 7, 3.0)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "1.json").write_text(json.dumps({"author": author, "stats": {"characters": chars, "sentence_length_mean": length}}), encoding="utf-8")
    first = lambda order: R.analyses(spark, str(tmp_path / "*" / "*.json"), order).first().author
    assert [first(o) for o in ("author", "path", "longest", "shortest sentences")] == ["a", "b", "b", "b"]
