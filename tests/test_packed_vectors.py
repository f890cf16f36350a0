"""TF-IDF vectors for pairs: counted where texts are read, sent as numbers, only entries of rare terms move."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import text as T
from tessera.plans import grid, joins
from tessera.plans.iterate import Materializer
from tessera.plans.registry import load_all


def words(rng, n):
    return " ".join(f"w{chr(97 + int(rng.paretovariate(0.8)) % 26)}{chr(97 + int(rng.paretovariate(0.5)) % 26)}" for _ in range(n))


def corpus(spark, n=60, also=()):
    rng = random.Random(5)
    rows = [(k, words(rng, rng.randint(1, 40))) for k in range(n)] + list(also)
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def plain(rows):
    """Vectors by key, the texts of a key taken together."""
    tf = {}
    for k, text in rows:
        tf.setdefault(k, Counter()).update("".join(c for c in w if c.isalpha()) for w in (text or "").lower().split())
    df = Counter(t for c in tf.values() for t in c if t)
    return {k: {t: n * math.log(len(rows) / df[t]) for t, n in c.items() if t} for k, c in tf.items()}


def cosine(v, a, b):
    if a is None or b is None or not v.get(a) or not v.get(b):
        return None
    norm = math.prod(sum(x * x for x in v[k].values()) for k in (a, b))
    return round(sum(s * v[b].get(t, 0.0) for t, s in v[a].items()) / math.sqrt(norm), 9) if norm else None


@pytest.mark.parametrize("bound", [64 << 20, 3000, 0])
def test_cosines_whether_terms_are_broadcast_or_move(spark, monkeypatch, bound):
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", bound)
    monkeypatch.setattr(T, "CHUNK_ENTRIES", 7)  # vectors come in several parts
    rows, docs = corpus(spark, also=[(3, "wab wzz once"), (3, None), (None, "wab wab"), (None, "alone"), (70, None), (71, "... 12"), (72, "last")])
    mat = Materializer(spark)
    vectors = T.doc_tfidf(docs, packed=mat)
    least = T.least_bounded_df(T.term_stats(T.term_frequency(docs, by=("doc_id",))))
    assert least == 1 if bound > 3000 else least > 1 if bound else least is None
    pairs = [(a, b) for a in (0, 3, 70, 71, 72, 99, None) for b in (*range(0, 60, 7), 3, 70, 71, 72, None)] + [(5, 6), (5, 6)]
    got = T.pairwise_cosine(vectors, spark.createDataFrame(pairs, "doc_a long, doc_b long"))
    mat.release_all_but()  # the vectors are read no more
    want = plain(rows)
    assert sorted((str(r.doc_a), str(r.doc_b), r.cosine if r.cosine is None else round(r.cosine, 9)) for r in got.collect()) == sorted(
        (str(a), str(b), cosine(want, a, b)) for a, b in pairs)


@pytest.mark.parametrize("query", ["hub_cosine", "pairwise_cosine"])
def test_queries_send_few_bytes_an_entry_and_no_text_of_a_key_of_its_own(spark, monkeypatch, tmp_path, query):
    rows, docs = corpus(spark, 300)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sent, moved = [], []
    answer, lists = grid.SparseGrid.answer, T.term_lists

    def measured(self, rows, *rest):
        width = sum((F.size(f.name) * 8 if f.dataType.typeName() == "array" else F.octet_length(f.name)
                     for f in rows.schema.fields if f.dataType.typeName() in ("string", "binary", "array")), F.lit(0))
        sent.append(rows.where("id <> 0").groupBy("id", "cell").agg(F.sum(width).alias("b")).groupBy("id").agg(F.max("b").alias("b")).agg(F.sum("b")).first()[0])
        return answer(self, rows, *rest)

    monkeypatch.setattr(grid.SparseGrid, "answer", measured)
    monkeypatch.setattr(T, "term_lists", lambda *a, **k: moved.append(a) or lists(*a, **k))
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 20_000)
    got = load_all()[0][query](spark, str(tmp_path)).collect()
    entries = sum(len(v) for k, v in plain(rows).items() if k)
    assert sent and sent[0] < 7 * entries and not moved
    want = plain(rows)
    assert len(got) == (299 if query == "pairwise_cosine" else 299 * 3)
    for r in got:
        c = cosine(want, r.doc_a, r.doc_b)
        assert r.cosine is None if c is None else abs(r.cosine - c) < 1.1e-6


def test_only_entries_of_rare_terms_move_by_term(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 3000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    _, docs = corpus(spark)
    plan = T.doc_tfidf(docs, packed=Materializer(spark))._jdf.queryExecution().executedPlan().toString().splitlines()
    at = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(term" in line]
    assert len(at) == 2 and any("isnull(no" in line for line in plan[at[0]:at[0] + 4])


def test_numbers_packed_by_row_come_back(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([[0, 127, 128, 1 << 62, -1, -(1 << 63)], rng.integers(0, 1 << 40, 50), rng.integers(0, 300, 50)])
    at = np.array([0, 1, 6, 6, 80, len(v)])
    back, places = T._unpacked_numbers(pa.chunked_array([T._packed_numbers(v, at)]))
    assert (back == v).all() and (places == at).all()
    none, places = T._unpacked_numbers(pa.chunked_array([], pa.binary()))
    assert len(none) == 0 and list(places) == [0]
