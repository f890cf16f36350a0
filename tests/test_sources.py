import os

import pytest

from tessera.sources import listing
from tessera.sources import readers as S
from tessera.sources import writers as W


def write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_scores(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "s.txt"), ["(u'banana', 3)", "('caf\\xe9', 1.5)", '("it\'s", 2)'])
    got = {r["term"]: r["score"] for r in S.read_scores(spark, p).collect()}
    assert got == {"banana": 3.0, "café": 1.5, "it's": 2.0}


def test_edges(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "e.txt"), ["(1, 2)", "(1,2)", "(3, 1)"])
    assert sorted(tuple(r) for r in S.read_edges(spark, p).collect()) == [(1, 2), (1, 2), (3, 1)]
    q = write(os.path.join(tmp_dir, "e2.txt"), ["('a', 'b')", "(u'b', u'c')"])
    assert sorted(tuple(r) for r in S.read_edges(spark, q, "string").collect()) == [("a", "b"), ("b", "c")]


def test_dense(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "d.csv"), ["1.0,2.1,3.1,4.5", "0,0,1,2"])
    rows = sorted(tuple(r) for r in S.read_dense(spark, p).collect())
    assert rows == [(0.0, 0.0, 1.0, 2.0), (1.0, 2.1, 3.1, 4.5)]


def test_sparse(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "x.txt"), ['({"f1": 1.0, "f2": 2.0}, -1)', "({u'g': 0.5}, +1)", "({}, 1)"])
    data, rows = S.read_sparse(spark, p)
    assert rows.count() == 3
    assert sorted((r["label"], r["feature"], r["value"]) for r in data.collect()) == [
        (-1, "f1", 1.0), (-1, "f2", 2.0), (1, "g", 0.5)]


def test_sparse_rejects_other_labels(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "bad.txt"), ['({"f": 1.0}, 0)'])
    _, rows = S.read_sparse(spark, p)
    with pytest.raises(Exception):
        rows.collect()


def test_ratings_and_folds(spark, tmp_dir):
    d = os.path.join(tmp_dir, "folds")
    os.makedirs(d)
    write(os.path.join(d, "fold0"), ["7,12,3.5", "1,2,1.0"])
    write(os.path.join(d, "fold1"), ["3,4,2.0"])
    assert S.read_ratings(spark, os.path.join(d, "fold0")).count() == 2
    got = sorted((r["user_id"], r["fold"]) for r in S.read_folds(spark, d, 2).collect())
    assert got == [(1, 0), (3, 1), (7, 0)]


def test_corpus_counts_empty_files(spark, tmp_dir):
    d = os.path.join(tmp_dir, "corpus")
    os.makedirs(d)
    write(os.path.join(d, "a.txt"), ["hello world", "again"])
    open(os.path.join(d, "b.txt"), "w").close()
    assert S.read_corpus(spark, d).count() == 2


def test_tuple_text_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("o'k", 2), ("b", 5)], "term string, tf long")
    out = os.path.join(tmp_dir, "tf")
    W.write_tuples(df, out, fmt="text")
    got = {r["term"]: r["score"] for r in S.read_scores(spark, out).collect()}
    assert got == {"o'k": 2.0, "b": 5.0}


def test_models_round_trip(spark, tmp_dir):
    W.save_dense_model(spark, [1.5, -2.0], os.path.join(tmp_dir, "beta"))
    assert S.load_dense_model(spark, os.path.join(tmp_dir, "beta")) == [1.5, -2.0]
    beta = spark.createDataFrame([("a", 0.25)], "feature string, value double")
    W.save_sparse_model(beta, os.path.join(tmp_dir, "sbeta"))
    assert S.load_sparse_model(spark, os.path.join(tmp_dir, "sbeta")).first()["value"] == 0.25


def test_corpus_of_nested_folders_and_odd_names(spark, tmp_dir):
    d = os.path.join(tmp_dir, "corpus")
    texts = {"a.txt": "one\ntwo", "sub/b c%20é.txt": "three", "sub/deep/empty.txt": "", "sub/_hidden.txt": "no", "_skip/x.txt": "no", "sub/.y": "no"}
    for name, text in texts.items():
        os.makedirs(os.path.dirname(os.path.join(d, name)), exist_ok=True)
        with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    want = {k: v for k, v in texts.items() if "no" != v}
    for path in (d, f"file:{d}", f"file://{d}", f"{tmp_dir}/cor*"):
        got = {r.doc_id.split("/corpus/")[1]: r.text for r in S.read_corpus(spark, path).collect()}
        assert got == want
    assert S.read_corpus(spark, os.path.join(d, "a.txt")).first()["text"] == "one\ntwo"
    assert listing.empty_files(spark, d)[0].endswith("empty.txt")
    with pytest.raises(ValueError):
        S.read_corpus(spark, os.path.join(tmp_dir, "nothing"))
