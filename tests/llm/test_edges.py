"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import (embedding_dedup, html_extract, mixing, piece_codec, quality, simhash, spotsigs, suffix_dedup,
                         token_counts, url_filter)
from tessera.llm.common import share_package

LONG = "word " * 60_000
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "one two three four"), (4, "one two three four"), (5, LONG),
         (None, "no id here"), (6, "Größe 漢字 😀 <|endoftext|> a\x00b")]


@pytest.fixture()
def docs(spark):
    share_package(spark)
    return (spark.createDataFrame(TEXTS, "doc_id long, text string")
            .withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("id", F.lit("x")).withColumn("fp", F.lit(None).cast("int")).withColumn("size", F.lit(7)).withColumn("k", F.lit(0))
            .withColumn("_copy", F.lit(3)).withColumn("_rate", F.lit("r")).withColumn("copy_of", F.lit(1)).withColumn("text_hash", F.lit(2)))


OPS = {"op2": suffix_dedup.op2, "op4": token_counts.op4, "op6": mixing.op6, "op8": piece_codec.op8,
       "op9": spotsigs.op9, "op10": simhash.op10}


@pytest.mark.parametrize("name", OPS)
def test_every_row_has_a_result(docs, name):
    rows = OPS[name](docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in TEXTS)


@pytest.mark.parametrize("name", OPS)
def test_empty_table(docs, name):
    assert OPS[name](docs.where("false")).collect() == []


def test_quality_without_and_with_one_class_of_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_documents(docs, none).collect()} == {0.5}
    some = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r.predicted == 1 for r in quality.score_documents(docs, some).collect())
    assert quality.score_documents(docs.where("false"), some).collect() == []
    assert quality.keep_good(docs, some).columns == docs.columns


def test_stages_keep_columns(docs):
    for stage in (simhash.keep_first, suffix_dedup.cut_repeats, mixing.mix):
        out = stage(docs)
        assert out.columns == docs.columns
        out.collect()
        assert stage(docs.where("false")).collect() == []
    assert sorted(str(r.doc_id) for r in simhash.keep_first(docs).collect()) == ["1", "4", "5", "6", "None"]


def test_pages(spark):
    share_package(spark)
    pages = spark.createDataFrame(
        [(1, None, None), (2, "x", ""), (3, "HTTP://A.Net", "<p>a"), (3, "HTTP://A.Net", "<p>a"), (None, "http://b.example.com/de/x?y#z", "<article>q" + "z " * 50_000),
         (4, "http://sub.org/fr/", "<script>"), (5, "a://b://c?d/e", "<")], "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("host", F.lit(2))
    got = {(r.page_id, r.text): r.n_chars for r in html_extract.op1(pages).collect()}
    assert got[(1, "")] == 0 and got[(3, "a")] == 1 and got[(5, "<")] == 1
    urls = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.op7(pages).collect()}
    assert urls[1] == ("", "", None, "allow") == urls[2]
    assert urls[3] == ("a.net", "", None, "allow")
    assert urls[None] == ("b.example.com", "/de/x", "example.com/de/", "block")
    assert urls[4] == ("sub.org", "/fr/", "org/fr/", "allow")
    assert urls[5][:2] == ("b:", "//c")
    for op in (html_extract.op1, url_filter.op7):
        assert op(pages.where("false")).collect() == []


def test_vectors(spark):
    share_package(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [1.0, None]), (7, [1.0, 0.0]), (8, [2.0, 0.001]),
            (9, [1.0, -0.0]), (10, [0.0, 1.0]), (11, [1.0, 0.0, 0.0]), (7, [1.0, 0.0]), (12, [1e-200, 0.0]), (13, [1e200, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("vector", F.lit(1))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.op3(df).collect())
    alone = [(i, 0, i) for i in (1, 2, 3, 4, 5, 6, 10, 11)]
    assert got == sorted(alone + [(i, 5, 7) for i in (7, 7, 8, 9, 12, 13)])
    assert embedding_dedup.op3(df.where("false")).collect() == []


def test_vectors_without_an_id(spark):
    share_package(spark)
    rows = [(None, [0.0, 1.0]), (None, [0.0, 1.0]), (1, [1.0, 0.0]), (None, [1.0, 0.001]), (0, [-1.0, 0.0]), (None, None)]
    got = embedding_dedup.op3(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == [
        ("0", 0, "0"), ("1", 1, "1"), ("None", 0, "None"), ("None", 1, "1"), ("None", 1, "None"), ("None", 1, "None")]
