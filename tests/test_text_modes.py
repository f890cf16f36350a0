"""The five text modes run file-to-file: TF, IDF, TFIDF, SIM, TOP."""

import math
import os

import pytest

from tessera.operators import text as T
from tessera.sources import readers as S
from tessera.sources import writers as W


def write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def scores(df, col="score"):
    return {r["term"]: r[col] for r in df.collect()}


def test_modes_file_to_file(spark, tmp_dir):
    corpus = os.path.join(tmp_dir, "corpus")
    os.makedirs(corpus)
    write(os.path.join(corpus, "a.txt"), "Banana apple\nbanana, cherry!\n")
    write(os.path.join(corpus, "b.txt"), "apple pie 42\n")
    write(os.path.join(corpus, "c.txt"), "")

    # TF of one file, written as tuple lines
    tf = T.term_frequency(S.read_lines(spark, os.path.join(corpus, "a.txt")), text="value")
    W.write_tuples(tf, os.path.join(tmp_dir, "tf"), fmt="text")
    tf_back = S.read_scores(spark, os.path.join(tmp_dir, "tf"))
    assert scores(tf_back) == {"banana": 2.0, "apple": 1.0, "cherry": 1.0}

    # IDF over the directory: the empty file counts in N = 3
    idf = T.inverse_document_frequency(S.read_corpus(spark, corpus))
    W.write_tuples(idf, os.path.join(tmp_dir, "idf"), fmt="text")
    idf_back = S.read_scores(spark, os.path.join(tmp_dir, "idf"))
    assert scores(idf_back)["apple"] == pytest.approx(math.log(3 / 2))
    assert scores(idf_back)["banana"] == pytest.approx(math.log(3))

    # TFIDF from the two files
    tfidf = T.tfidf(tf_back.withColumnRenamed("score", "tf"), idf_back.withColumnRenamed("score", "idf"))
    got = scores(tfidf, "tfidf")
    assert got["banana"] == pytest.approx(2 * math.log(3))
    assert got["apple"] == pytest.approx(math.log(3 / 2))

    # SIM of a vector with itself, TOP of the counts
    v = tfidf.withColumnRenamed("tfidf", "score")
    assert T.cosine_similarity(v, v).first()["cosine"] == pytest.approx(1.0)
    top = [r["term"] for r in T.top_terms(tf_back, "score", 2).collect()]
    assert top == ["banana", "apple"]
