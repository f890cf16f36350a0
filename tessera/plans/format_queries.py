"""Registered queries of the file formats (S1-S12, M12): a table written in a
format and read back.  What comes out has to equal the table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import factor as M, linear as L, text as T
from ..session import ensure_checkpoint_dir
from ..sources import readers as S, writers as W
from . import fixtures as fx
from .factor_queries import D, GAIN, LAM, MU, POWER, SEED, _init_sql, _joined_sql, _prof_df, _prof_out, _update_sql
from .linear_queries import FIT_EPS, FIT_MAX_ITER, X, Y
from .oracle_sql import CORPUS, DENSE, LINKS_OUT, RATINGS, r6 as s6, sparse_cte, terms_sql
from .registry import r6, register


@register("score_lines", f"SELECT text AS term, length(text)::DOUBLE AS score FROM ({CORPUS})")
def score_lines(spark, sf_dir):
    """Whole texts as terms: quotes, escapes and line breaks have to survive."""
    docs = fx.corpus(spark, sf_dir).select("text", F.length("text").alias("n"))
    return S.parse_scores(W.tuple_lines(docs))


@register("edge_lines", LINKS_OUT)
def edge_lines(spark, sf_dir):
    return S.parse_edges(W.tuple_lines(fx.links_out(spark, sf_dir)))


@register("name_edge_lines", "SELECT c_name AS src, c_mktsegment AS dst FROM customer")
def name_edge_lines(spark, sf_dir):
    names = fx.table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    return S.parse_edges(W.tuple_lines(names), "string")


@register("dense_lines", f"SELECT {s6('x1')} AS x0, {s6('x2')} AS x1, {s6('y')} AS y FROM ({DENSE})")
def dense_lines(spark, sf_dir):
    rows = fx.dense(spark, sf_dir)
    lines = rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in ("x1", "x2", "y")]).alias("value"))
    return S.parse_dense(lines, 2).select(*[r6(c).alias(c) for c in ("x0", "x1", "y")])


@register("rating_lines", f"SELECT user_id, item_id, {s6('rating')} AS rating FROM ({RATINGS})")
def rating_lines(spark, sf_dir):
    rows = fx.ratings(spark, sf_dir)
    lines = rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in rows.columns]).alias("value"))
    return S.parse_ratings(lines).select("user_id", "item_id", r6("rating").alias("rating"))


@register("sparse_lines", f"""WITH {sparse_cte()}
SELECT label, feature, count(*) AS n, {s6("sum(value)")} AS total FROM sparse GROUP BY label, feature""")
def sparse_lines(spark, sf_dir):
    """One line per document; a document's features are the one list gathered."""
    item = F.concat(F.lit("u'"), "feature", F.lit("': "), F.col("value").cast("string"))
    lines = (fx.sparse(spark, sf_dir).groupBy("row_id", "label").agg(F.array_join(F.collect_list(item), ", ").alias("b"))
             .select(F.concat(F.lit("({"), "b", F.lit("}, "), F.col("label").cast("string"), F.lit(")")).alias("value")))
    data, _ = S.parse_sparse(lines)
    return data.groupBy("label", "feature").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("value")).alias("total"))


def _new_path(spark, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("line_files", f"SELECT '(' || src || ', ' || dst || ')' AS value FROM ({LINKS_OUT})")
def line_files(spark, sf_dir):
    """S1: lines of a written text folder."""
    path = _new_path(spark, "lines")
    W.write_tuples(fx.links_out(spark, sf_dir), path, fmt="text")
    return S.read_lines(spark, path)


@register("corpus_files", f"SELECT doc_id, text FROM ({CORPUS})")
def corpus_files(spark, sf_dir):
    """S2: a file per document, read back whole."""
    path = _new_path(spark, "corpus")
    W.write_corpus(fx.corpus(spark, sf_dir), path)
    name = F.regexp_extract("doc_id", r"/(-?\d+)\.txt$", 1)
    return S.read_corpus(spark, path).select(name.try_cast("long").alias("doc_id"), "text")


FOLD_FILES = 5


@register("fold_files", f"""SELECT user_id, item_id, {s6('rating')} AS rating,
CAST((31 * user_id + item_id) % {FOLD_FILES} AS INTEGER) AS fold FROM ({RATINGS})""")
def fold_files(spark, sf_dir):
    """S8: a folder ``fold0 .. fold4``."""
    path = _new_path(spark, "folds")
    folds = fx.rating_folds(spark, sf_dir, FOLD_FILES)
    lines = folds.select("fold", F.concat_ws(",", *[F.col(c).cast("string") for c in ("user_id", "item_id", "rating")]).alias("value"))
    for k in range(FOLD_FILES):
        lines.where(F.col("fold") == k).select("value").write.text(f"{path}/fold{k}")
    return S.read_folds(spark, path, FOLD_FILES).select("user_id", "item_id", r6("rating").alias("rating"), "fold")


@register("small_file", f"""WITH corpus AS ({CORPUS}), toks AS ({terms_sql('corpus')})
SELECT term, count(*)::DOUBLE AS score FROM toks GROUP BY term ORDER BY score DESC, term LIMIT 20""")
def small_file(spark, sf_dir):
    """S10: the top terms as one file of tuple lines."""
    path = _new_path(spark, "top")
    W.write_small(T.top_terms(T.term_frequency(fx.corpus(spark, sf_dir)), "tf", 20), path, fmt="text")
    return S.read_scores(spark, path)


@register("dense_model_file", f"""WITH d AS ({DENSE}), g AS (SELECT avg(x1 * x1) + 1 AS a, avg(x1 * x2) AS b, avg(x2 * x2) + 1 AS c,
avg(x1 * y) AS p, avg(x2 * y) AS q FROM d WHERE NOT is_test)
SELECT 0 AS idx, {s6('(p * c - b * q) / (a * c - b * b)', 4)} AS beta FROM g
UNION ALL SELECT 1, {s6('(a * q - b * p) / (a * c - b * b)', 4)} FROM g""")
def dense_model_file(spark, sf_dir):
    """S11: a fitted dense model, saved and loaded."""
    path = _new_path(spark, "dense-model")
    fit = L.train_ridge(fx.dense_train(spark, sf_dir), X, Y, 1.0, FIT_MAX_ITER, FIT_EPS)
    W.save_dense_model(spark, fit.beta, path)
    return L.beta_frame(spark, S.load_dense_model(spark, path)).select("idx", r6("value", 4).alias("beta"))


@register("sparse_model_file", f"""WITH {sparse_cte()}
SELECT feature, {s6('sum(label * value) / 2.0')} AS value FROM sparse GROUP BY feature""")
def sparse_model_file(spark, sf_dir):
    """S12: a sparse model (half a gradient step from nothing), saved and loaded."""
    path = _new_path(spark, "sparse-model")
    data = fx.sparse(spark, sf_dir)
    W.save_sparse_model(data.groupBy("feature").agg((F.sum(F.col("label") * F.col("value")) / 2.0).alias("value")), path)
    return S.load_sparse_model(spark, path).select("feature", r6("value").alias("value"))


_G1 = M.gain_at(1, GAIN, POWER)


@register("mf_model_files", f"""WITH r AS ({RATINGS}),
u0 AS MATERIALIZED {_init_sql('r', 'user_id', SEED)}, v0 AS MATERIALIZED {_init_sql('r', 'item_id', SEED + 1)},
j1 AS MATERIALIZED {_joined_sql('r', 'u0', 'v0')}
SELECT 'U' AS side, {_prof_out('user_id').replace('user_id,', 'user_id AS id,')} FROM {_update_sql('j1', 'user_id', 'u', 'v', _G1, LAM)}
UNION ALL
SELECT 'V', {_prof_out('item_id')} FROM {_update_sql('j1', 'item_id', 'v', 'u', _G1, MU)}""")
def mf_model_files(spark, sf_dir):
    """M12: a fit on all ratings that writes both profile tables, read back."""
    path = _new_path(spark, "mf")
    M.fit_full(fx.ratings(spark, sf_dir), path, d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU, max_iter=1, seed=SEED)
    parts = [_prof_df(spark.read.parquet(f"{path}_{side}"), key).withColumnRenamed(key, "id").withColumn("side", F.lit(side))
             for side, key in (("U", "user_id"), ("V", "item_id"))]
    return parts[0].unionByName(parts[1])
