"""Registered text queries (T1-T8b, S2) over the ``documents`` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import normalize_term, split_words
from ..operators import text as T
from . import fixtures as fx
from .iterate import Materializer
from .oracle_sql import CORPUS, HUB_PAIRS, WS, r6 as s6, terms_sql
from .registry import r6, register

_TOKENS = f"corpus AS ({CORPUS}), toks AS ({terms_sql('corpus')})"


@register("normalize_terms", f"""
WITH corpus AS ({CORPUS}),
words AS (SELECT DISTINCT w AS word FROM (
  SELECT unnest(string_split_regex(text, '{WS}')) AS w
  FROM corpus) WHERE w <> '')
SELECT word, regexp_replace(lower(word), '[^\\p{{L}}]', '', 'g') AS term FROM words""")
def normalize_terms(spark, sf_dir):
    words = (fx.corpus(spark, sf_dir).select(F.explode(split_words("text")).alias("word"))
             .where(F.col("word") != "").distinct())
    return words.select("word", normalize_term("word").alias("term"))


@register("tokenize", f"""
WITH {_TOKENS}
SELECT doc_id, count(*) AS n_terms FROM toks GROUP BY doc_id""")
def tokenize_counts(spark, sf_dir):
    toks = T.tokenize(fx.corpus(spark, sf_dir), keep=("doc_id",))
    return toks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"))


@register("term_frequency", f"""
WITH {_TOKENS}
SELECT term, count(*) AS tf FROM toks GROUP BY term""")
def term_frequency(spark, sf_dir):
    return T.term_frequency(fx.corpus(spark, sf_dir))


@register("doc_term_frequency", f"""
WITH {_TOKENS}
SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term""")
def doc_term_frequency(spark, sf_dir):
    return T.term_frequency(fx.corpus(spark, sf_dir), by=("doc_id",))


@register("top_terms", f"""
WITH {_TOKENS}
SELECT term, count(*) AS tf FROM toks GROUP BY term ORDER BY tf DESC, term LIMIT 20""")
def top_terms(spark, sf_dir):
    return T.top_terms(T.term_frequency(fx.corpus(spark, sf_dir)), "tf", 20)


@register("document_frequency", f"""
WITH {_TOKENS}
SELECT term, count(DISTINCT doc_id) AS df FROM toks GROUP BY term""")
def document_frequency(spark, sf_dir):
    return T.document_frequency(fx.corpus(spark, sf_dir))


@register("corpus_size", f"""
WITH corpus AS ({CORPUS}) SELECT count(*) AS n_docs FROM corpus""")
def corpus_size(spark, sf_dir):
    return T.corpus_size(fx.corpus(spark, sf_dir))


_IDF = f"""{_TOKENS},
n AS (SELECT count(*) AS n_docs FROM corpus),
idf AS (SELECT term, ln((SELECT n_docs FROM n)::DOUBLE / count(DISTINCT doc_id)) AS idf
        FROM toks GROUP BY term)"""


@register("idf", f"""
WITH {_IDF}
SELECT term, {s6('idf')} AS idf FROM idf""")
def idf(spark, sf_dir):
    out = T.inverse_document_frequency(fx.corpus(spark, sf_dir))
    return out.select("term", r6("idf").alias("idf"))


@register("tfidf", f"""
WITH {_IDF},
tf AS (SELECT term, count(*) AS tf FROM toks GROUP BY term)
SELECT term, {s6('tf * idf')} AS tfidf FROM tf JOIN idf USING (term) ORDER BY tfidf DESC, term""")
def tfidf(spark, sf_dir):
    """TF of the corpus times IDF, joined by term, the best first."""
    docs = fx.corpus(spark, sf_dir)
    out = T.tfidf(T.term_frequency(docs), T.inverse_document_frequency(docs))
    return T.ranked_scores(out.select("term", r6("tfidf").alias("tfidf")), "tfidf")


@register("corpus_tfidf", f"""
WITH {_IDF},
tf AS (SELECT term, count(*) AS tf FROM toks GROUP BY term)
SELECT term, {s6('tf * idf')} AS tfidf FROM tf JOIN idf USING (term)""")
def corpus_tfidf(spark, sf_dir):
    """The same scores from one aggregate."""
    return T.corpus_tfidf(fx.corpus(spark, sf_dir)).select("term", r6("tfidf").alias("tfidf"))


@register("doc_tfidf", f"""
WITH {_IDF},
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term)
SELECT doc_id, term, {s6('tf * idf')} AS tfidf FROM tf JOIN idf USING (term)""")
def doc_tfidf(spark, sf_dir):
    out = T.doc_tfidf(fx.corpus(spark, sf_dir))
    return out.select("doc_id", "term", r6("tfidf").alias("tfidf"))


@register("cosine_similarity", f"""
WITH {_IDF},
bench AS (SELECT item_id AS doc_id, text FROM benchmark),
btoks AS ({terms_sql('bench')}),
a AS (SELECT term, count(*) * idf AS s FROM toks JOIN idf USING (term) GROUP BY term, idf),
b AS (SELECT term, count(*) * idf AS s FROM btoks JOIN idf USING (term) GROUP BY term, idf),
dot AS (SELECT coalesce(sum(a.s * b.s), 0.0) AS d FROM a JOIN b USING (term)),
den AS (SELECT sqrt((SELECT sum(s * s) FROM a) * (SELECT sum(s * s) FROM b)) AS q)
SELECT {s6('CASE WHEN q > 0 THEN d / q END')} AS cosine FROM dot, den""")
def cosine_similarity(spark, sf_dir):
    """TF-IDF of the whole corpus against TF-IDF of the benchmark passages
    (both weighted by the corpus IDF)."""
    docs = fx.corpus(spark, sf_dir)
    idf = T.inverse_document_frequency(docs)
    a = T.corpus_tfidf(docs)
    b = T.tfidf(T.term_frequency(fx.benchmark_texts(spark, sf_dir)), idf)
    out = T.cosine_similarity(a, b, score="tfidf")
    return out.select(r6("cosine").alias("cosine"))


@register("pairwise_cosine", f"""
WITH {_IDF},
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
v AS (SELECT doc_id, term, tf * idf AS s FROM tf JOIN idf USING (term)),
pairs AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM corpus a JOIN corpus b ON b.doc_id = a.doc_id + 1),
norms AS (SELECT doc_id, sum(s * s) AS n FROM v GROUP BY doc_id),
dots AS (SELECT p.doc_a, p.doc_b, sum(va.s * vb.s) AS d FROM pairs p
         JOIN v va ON va.doc_id = p.doc_a JOIN v vb ON vb.doc_id = p.doc_b AND vb.term = va.term
         GROUP BY p.doc_a, p.doc_b)
SELECT p.doc_a, p.doc_b,
       {s6('CASE WHEN na.n * nb.n > 0 THEN coalesce(dots.d, 0.0) / sqrt(na.n * nb.n) END')} AS cosine
FROM pairs p LEFT JOIN norms na ON na.doc_id = p.doc_a LEFT JOIN norms nb ON nb.doc_id = p.doc_b
LEFT JOIN dots ON dots.doc_a = p.doc_a AND dots.doc_b = p.doc_b""")
def pairwise_cosine(spark, sf_dir):
    mat = Materializer(spark)
    vectors = T.doc_tfidf(fx.corpus(spark, sf_dir), packed=mat)
    out = T.pairwise_cosine(vectors, fx.consecutive_pairs(spark, sf_dir))
    mat.release_all_but()
    return out.select("doc_a", "doc_b", r6("cosine").alias("cosine"))


@register("hub_cosine", f"""
WITH {_IDF},
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
v AS (SELECT doc_id, term, tf * idf AS s FROM tf JOIN idf USING (term)),
pairs AS ({HUB_PAIRS}),
norms AS (SELECT doc_id, sum(s * s) AS n FROM v GROUP BY doc_id),
dots AS (SELECT p.doc_a, p.doc_b, sum(va.s * vb.s) AS d FROM pairs p
         JOIN v va ON va.doc_id = p.doc_a JOIN v vb ON vb.doc_id = p.doc_b AND vb.term = va.term
         GROUP BY p.doc_a, p.doc_b)
SELECT p.doc_a, p.doc_b,
       {s6('CASE WHEN na.n * nb.n > 0 THEN coalesce(dots.d, 0.0) / sqrt(na.n * nb.n) END')} AS cosine
FROM pairs p LEFT JOIN norms na ON na.doc_id = p.doc_a LEFT JOIN norms nb ON nb.doc_id = p.doc_b
LEFT JOIN dots ON dots.doc_a = p.doc_a AND dots.doc_b = p.doc_b""")
def hub_cosine(spark, sf_dir):
    """One document in a third of all pairs: the first with every other, and every other with its next two."""
    mat = Materializer(spark)
    vectors = T.doc_tfidf(fx.corpus(spark, sf_dir), packed=mat)
    out = T.pairwise_cosine(vectors, fx.hub_pairs(spark, sf_dir))
    mat.release_all_but()
    return out.select("doc_a", "doc_b", r6("cosine").alias("cosine"))
