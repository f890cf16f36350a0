"""Registered sparse-vector queries (V1-V5).

``a`` = the labelled documents' normalised term counts (the ``sparse``
view); ``b`` = TF-IDF vectors of all documents.  Both are keyed by row_id.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sparse as V
from ..operators import text as T
from . import fixtures as fx
from .oracle_sql import r6 as s6, sparse_cte
from .registry import r6, register
from .text_queries import _IDF

BY = ("row_id",)

_AB = f"""WITH {_IDF},
{sparse_cte()},
a AS (SELECT row_id, feature, value FROM sparse),
dtf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY doc_id, term),
b AS (SELECT doc_id AS row_id, term AS feature, tf * idf AS value FROM dtf JOIN idf USING (term))"""


def _a(spark, sf_dir):
    return fx.sparse(spark, sf_dir).select("row_id", "feature", "value")


def _b(spark, sf_dir):
    v = T.doc_tfidf(fx.corpus(spark, sf_dir))
    return v.select(F.col("doc_id").alias("row_id"), F.col("term").alias("feature"),
                    F.col("tfidf").alias("value"))


def _out(df):
    return df.select("row_id", "feature", r6("value").alias("value"))


@register("sparse_get", f"""{_AB}
SELECT k.doc_id AS row_id, k.term AS feature, {s6('coalesce(a.value, 0.0)')} AS value
FROM dtf k LEFT JOIN a ON a.row_id = k.doc_id AND a.feature = k.term""")
def sparse_get(spark, sf_dir):
    keys = T.term_frequency(fx.corpus(spark, sf_dir), by=("doc_id",)).select(
        F.col("doc_id").alias("row_id"), F.col("term").alias("feature"))
    return _out(V.sparse_get(_a(spark, sf_dir), keys, BY))


@register("sparse_dot", f"""{_AB},
d AS (SELECT a.row_id, sum(a.value * b.value) AS dot FROM a JOIN b USING (row_id, feature) GROUP BY a.row_id)
SELECT k.row_id, {s6('coalesce(d.dot, 0.0)')} AS dot FROM (SELECT DISTINCT row_id FROM a) k
LEFT JOIN d USING (row_id)""")
def sparse_dot(spark, sf_dir):
    out = V.sparse_dot(_a(spark, sf_dir), _b(spark, sf_dir), BY)
    return out.select("row_id", r6("dot").alias("dot"))


@register("sparse_add", f"""{_AB}
SELECT row_id, feature, {s6('sum(value)')} AS value FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
GROUP BY row_id, feature""")
def sparse_add(spark, sf_dir):
    return _out(V.sparse_add(_a(spark, sf_dir), _b(spark, sf_dir), BY))


@register("sparse_sub", f"""{_AB}
SELECT row_id, feature, {s6('sum(value)')} AS value
FROM (SELECT * FROM a UNION ALL SELECT row_id, feature, -value FROM b) GROUP BY row_id, feature""")
def sparse_sub(spark, sf_dir):
    return _out(V.sparse_sub(_a(spark, sf_dir), _b(spark, sf_dir), BY))


@register("sparse_scale", f"""{_AB}
SELECT row_id, feature, {s6('2.0 * value')} AS value FROM a""")
def sparse_scale(spark, sf_dir):
    return _out(V.sparse_scale(_a(spark, sf_dir), 2.0, BY))
