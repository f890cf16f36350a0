"""Terms are counted where a document's words meet, and rows per term do not move."""

from pyspark.sql import functions as F

from tessera.operators import logistic as LG, sparse as V, text as T
from tessera.plans import fixtures as fx, iterate


def docs(spark):
    return spark.createDataFrame([(1, "b a B, a"), (1, "a c"), (2, None), (3, "..."), (None, "x x"), (4, "b")], "doc_id long, text string")


def exchanges(df) -> list[str]:
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_texts_of_one_key_are_counted_together(spark):
    got = sorted((r.doc_id or 0, r.term, r.tf) for r in T.term_frequency(docs(spark), by=("doc_id",)).collect())
    assert got == [(0, "x", 2), (1, "a", 3), (1, "b", 2), (1, "c", 1), (4, "b", 1)]


def test_only_texts_move_when_terms_are_counted_and_added(spark):
    tf = T.term_frequency(docs(spark), by=("doc_id",))
    moved = exchanges(tf)
    assert len(moved) == 1 and "term" not in moved[0]
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    a = tf.select("doc_id", F.col("term").alias("feature"), F.col("tf").cast("double").alias("value"))
    for out in (V.sparse_add(a, a, ("doc_id",)), V.sparse_get(a, a, ("doc_id",)), V.sparse_dot(a, a, ("doc_id",))):
        assert not any("feature" in line for line in exchanges(out))
    assert sorted((r.doc_id or 0, r.value) for r in V.sparse_add(a, a, ("doc_id",)).where("feature = 'b'").collect()) == [(1, 4.0), (4, 2.0)]


def test_labels_and_documents_that_come_twice(spark, tmp_path):
    docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (1, 1), (1, 0), (4, None), (5, 1), (None, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    want = sorted([(1, 1, "a", 6 / 18), (1, 1, "b", 4 / 18), (1, 1, "c", 2 / 18), (1, -1, "a", 3 / 18), (1, -1, "b", 2 / 18),
                   (1, -1, "c", 1 / 18), (4, -1, "b", 1.0)])
    assert sorted(map(tuple, fx.sparse(spark, str(tmp_path)).collect())) == want


def test_a_vector_is_sent_as_one_row_whatever_its_terms_hold(spark):
    odd = ["a\x1eb", "a", "b", "\x1f", "\x1fe", "\x1fn", "", None]
    v = spark.createDataFrame([(k, t, float(k + j)) for k in (1, 2) for j, t in enumerate(odd[k - 1:])], "doc_id long, term string, tfidf double")
    x, y = ({t: float(k + j) for j, t in enumerate(odd[k - 1:])} for k in (1, 2))
    want = sum(s * y.get(t, 0.0) for t, s in x.items()) / (sum(s * s for s in x.values()) * sum(s * s for s in y.values())) ** 0.5
    got = T.pairwise_cosine(v, spark.createDataFrame([(1, 2)], "doc_a long, doc_b long")).first()
    assert abs(got["cosine"] - want) < 1e-12


def test_training_rows_as_test_set_are_stored_once(spark, monkeypatch):
    data = spark.createDataFrame([(1, "a", 1.0), (2, "b", 0.5)], "row_id long, feature string, value double")
    rows = spark.createDataFrame([(1, 1), (2, -1)], "row_id long, label int")
    kept = []
    store = iterate.Materializer.__call__
    monkeypatch.setattr(iterate.Materializer, "__call__", lambda self, df: kept.append(df.columns) or store(self, df))
    fit = LG.train_logistic(data, rows, 0.1, max_iter=1, eps=0.0, test=(data, rows))
    assert fit.history[0][4] == 1.0 and kept.count(["row_id", "feature", "value"]) == 1


def test_a_text_read_as_a_whole_gives_the_words_normalised_one_by_one(spark):
    from tessera.functions.text import normalize_term, plain_words, split_words

    odd = ["", None, " ", "a  b", "\t(A-b)\u0085c\u2003D9 \u180e x", "ΟΔΟΣ ΟΔΟΣ. ΣΑΣ9Σ", "İstanbul 123 ... \x1cé\u0301 \U00010400z", "\u00a0q\u200bw\u3000"]
    df = spark.createDataFrame([(t,) for t in odd], "text string")
    old = F.concat_ws(" ", F.filter(F.transform(split_words("text"), normalize_term), lambda t: t != ""))
    rows = df.select(plain_words("text").alias("new"), old.alias("old")).collect()
    assert [r.new for r in rows] == [r.old for r in rows] and rows[3].new == "a b"
