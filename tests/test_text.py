import math

import pytest

from tessera.operators import text as T


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_normalize_and_count(spark):
    tf = T.term_frequency(docs(spark, ["Ba,Na:Na.123 banana 42"]))
    assert as_dict(tf, "term", "tf") == {"banana": 2}


def test_unicode_letters_and_whitespace(spark):
    text = "Été été　ÉTÉ\x1cnaïve 123 über\x85Über"
    tf = T.term_frequency(docs(spark, [text]))
    expected = {}
    for w in text.split():
        t = "".join(c for c in w.lower() if c.isalpha())
        if t:
            expected[t] = expected.get(t, 0) + 1
    assert as_dict(tf, "term", "tf") == expected


def test_idf_counts_empty_documents(spark):
    idf = as_dict(T.inverse_document_frequency(docs(spark, ["a b", "a", ""])), "term", "idf")
    assert idf["a"] == pytest.approx(math.log(3 / 2))
    assert idf["b"] == pytest.approx(math.log(3))


def test_tfidf_inner_join(spark):
    tf = spark.createDataFrame([("a", 2), ("c", 1)], "term string, tf long")
    idf = spark.createDataFrame([("a", 0.5), ("b", 1.0)], "term string, idf double")
    assert as_dict(T.tfidf(tf, idf), "term", "tfidf") == {"a": 1.0}


@pytest.mark.parametrize("other,expected", [({"a": 3, "b": 4}, 1.0), ({"a": 1}, 0.6), ({"c": 1}, 0.0)])
def test_cosine(spark, other, expected):
    a = spark.createDataFrame([("a", 3.0), ("b", 4.0)], "term string, score double")
    b = spark.createDataFrame([(k, float(v)) for k, v in other.items()], "term string, score double")
    assert T.cosine_similarity(a, b).first()["cosine"] == pytest.approx(expected)


def test_cosine_zero_norm_is_null(spark):
    a = spark.createDataFrame([("a", 0.0)], "term string, score double")
    assert T.cosine_similarity(a, a).first()["cosine"] is None


def test_pairwise_cosine(spark):
    vec = spark.createDataFrame([(1, "a", 3.0), (1, "b", 4.0), (2, "a", 1.0), (3, "c", 1.0)],
                                "doc_id long, term string, tfidf double")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 1), (2, 9)], "doc_a long, doc_b long")
    got = {(r["doc_a"], r["doc_b"]): r["cosine"] for r in T.pairwise_cosine(vec, pairs).collect()}
    assert got[(1, 2)] == pytest.approx(0.6)
    assert got[(1, 3)] == 0.0
    assert got[(1, 1)] == pytest.approx(1.0)
    assert got[(2, 9)] is None


def test_top_terms_tie_break(spark):
    s = spark.createDataFrame([("b", 2), ("a", 2), ("c", 5), ("d", 1)], "term string, tf long")
    assert [r["term"] for r in T.top_terms(s, "tf", 3).collect()] == ["c", "a", "b"]


def test_document_frequency(spark):
    df = as_dict(T.document_frequency(docs(spark, ["a a b", "a", "c"])), "term", "df")
    assert df == {"a": 2, "b": 1, "c": 1}


def test_pairwise_cosine_in_a_grid(spark):
    import math
    import random

    rng = random.Random(3)
    vectors = {k: {f"t{j}": rng.random() for j in rng.sample(range(30), rng.randint(1, 12))} for k in range(40)}
    vectors[7] = {"t1": 0.0}
    pairs = [(0, k) for k in range(40)] + [(rng.randrange(40), rng.randrange(45)) for _ in range(60)] + [(None, 1), (2, None), (3, 5), (3, 5)]
    V = spark.createDataFrame([(k, t, s) for k, v in vectors.items() for t, s in v.items()], "doc_id long, term string, tfidf double")

    def plain(a, b):
        if a not in vectors or b not in vectors:
            return None
        norm = math.prod(sum(x * x for x in vectors[k].values()) for k in (a, b))
        return sum(s * vectors[b].get(t, 0.0) for t, s in vectors[a].items()) / math.sqrt(norm) if norm else None

    want = sorted((str(a), str(b), None if plain(a, b) is None else round(plain(a, b), 9)) for a, b in pairs)
    P = spark.createDataFrame(pairs, "doc_a long, doc_b long")
    for side, hot in ((None, None), (1, None), (5, 6)):
        got = T.pairwise_cosine(V, P, side=side, hot_pairs=hot).collect()
        assert sorted((str(r.doc_a), str(r.doc_b), None if r.cosine is None else round(r.cosine, 9)) for r in got) == want
    named = T.pairwise_cosine(V.selectExpr("concat('d', doc_id) AS doc_id", "term", "tfidf"),
                              P.selectExpr("concat('d', doc_a) AS doc_a", "concat('d', doc_b) AS doc_b"), side=2).collect()
    assert sorted((str(r.doc_a)[1:], str(r.doc_b)[1:], r.cosine and round(r.cosine, 9)) for r in named if r.doc_a and r.doc_b) == sorted(
        w for w in want if "None" not in w[:2])
    assert T.pairwise_cosine(V, P.where("false")).collect() == []
