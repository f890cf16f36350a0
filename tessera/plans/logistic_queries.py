"""Registered sparse logistic-regression queries (L1-L11) over ``sparse``.

The single-step queries evaluate at a probe model derived from the data:
``b_f = sum_rows y x_f / 2`` (one unit gradient step from the empty model).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import logistic as LG
from ..operators.linear import LINE_SEARCH_A, LINE_SEARCH_B
from ..session import ensure_checkpoint_dir
from ..sources.models import load_versions
from . import fixtures as fx
from .oracle_sql import r6 as s6, sparse_cte
from .registry import r6, register

LAM = 0.1
DELTA = 1e-4
TRAIN_ITERS = 2
# trials that the SQL twins unroll: more than the tables need
SQL_TRIALS = 60


def _loss(m: str) -> str:
    return f"(greatest(-({m}), 0.0) + ln(1 + exp(-abs({m}))))"


_BASE = f"""WITH {sparse_cte()},
probe AS (SELECT feature, sum(label * value) / 2.0 AS value FROM sparse GROUP BY feature)"""


def _z_sql(beta: str, name: str = "z") -> str:
    return (f"(SELECT r.row_id, r.label, coalesce(sum(s.value * b.value), 0.0) AS {name} "
            f"FROM sparse_rows r LEFT JOIN sparse s USING (row_id) LEFT JOIN {beta} b USING (feature) "
            f"GROUP BY r.row_id, r.label)")


def _grad_sql(beta: str, z: str) -> str:
    return f"""(SELECT coalesce(gd.feature, b.feature) AS feature, coalesce(b.value, 0.0) AS b,
        coalesce(gd.gsum, 0.0) + 2.0 * {LAM!r} * coalesce(b.value, 0.0) AS g
      FROM (SELECT s.feature, sum(-z.label / (1 + exp(z.label * z.z)) * s.value) AS gsum
            FROM sparse s JOIN {z} z USING (row_id) GROUP BY s.feature) gd
      FULL OUTER JOIN {beta} b ON b.feature = gd.feature)"""


def _step_sql(i: int, beta: str) -> str:
    """CTEs z{i}, g{i}, h{i}, nrm{i}, obj{i}, trial{i}, step{i} for a step from ``beta``."""
    return f""",
z{i} AS MATERIALIZED {_z_sql(beta)},
g{i} AS MATERIALIZED {_grad_sql(beta, f'z{i}')},
h{i} AS MATERIALIZED (SELECT z.row_id, z.label, z.z, coalesce(sum(s.value * g.g), 0.0) AS h
       FROM z{i} z LEFT JOIN sparse s USING (row_id) LEFT JOIN g{i} g USING (feature)
       GROUP BY z.row_id, z.label, z.z),
nrm{i} AS (SELECT sum(b * b) AS bb, sum(b * g) AS bg, sum(g * g) AS gg FROM g{i}),
obj{i} AS (SELECT sum({_loss('label * z')}) + {LAM!r} * (SELECT bb FROM nrm{i}) AS f FROM h{i}),
grid{i} AS (SELECT range AS k, pow({LINE_SEARCH_B!r}, range) AS t FROM range({SQL_TRIALS})),
trial{i} AS (SELECT k, t, sum({_loss('label * (z - t * h)')}) + {LAM!r} * (bb - 2 * t * bg + t * t * gg) AS f
       FROM grid{i}, h{i}, nrm{i} GROUP BY k, t, bb, bg, gg),
pick{i} AS (SELECT min(k) AS k FROM trial{i}, obj{i}, nrm{i}
       WHERE trial{i}.f <= obj{i}.f - {LINE_SEARCH_A!r} * trial{i}.t * gg),
step{i} AS (SELECT coalesce((SELECT t FROM trial{i} WHERE k = (SELECT k FROM pick{i})), 0.0) AS t,
       coalesce((SELECT k FROM pick{i}), {SQL_TRIALS}) AS k,
       coalesce((SELECT f FROM trial{i} WHERE k = (SELECT k FROM pick{i})), (SELECT f FROM obj{i})) AS f_after)"""


def _data(spark, sf_dir):
    return fx.sparse(spark, sf_dir), fx.sparse_rows(spark, sf_dir)


def _probe(data):
    return data.groupBy("feature").agg((F.sum(F.col("label") * F.col("value")) / 2.0).alias("value"))


@register("feature_universe", f"{_BASE} SELECT DISTINCT feature FROM sparse")
def feature_universe(spark, sf_dir):
    data, _ = _data(spark, sf_dir)
    return LG.feature_universe(data)


@register("dataset_summary", f"""{_BASE}
SELECT (SELECT count(*) FROM sparse_rows) AS n_points, (SELECT count(DISTINCT feature) FROM sparse) AS n_features""")
def dataset_summary(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    return LG.dataset_summary(data, rows)


@register("margins", f"""{_BASE}
SELECT row_id, label, {s6('z')} AS z FROM {_z_sql('probe')}""")
def margins(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    return LG.margins(data, rows, _probe(data)).select("row_id", "label", r6("z").alias("z"))


@register("logistic_loss", f"""{_BASE}
SELECT row_id, label, {s6(_loss('label * z'))} AS loss FROM {_z_sql('probe')}""")
def logistic_loss(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    out = LG.logistic_loss(data, rows, _probe(data))
    return out.select("row_id", "label", r6("loss").alias("loss"))


@register("total_logistic_loss", f"""{_BASE}
SELECT {s6(f"sum({_loss('label * z')}) + {LAM!r} * (SELECT sum(value * value) FROM probe)")} AS loss
FROM {_z_sql('probe')}""")
def total_logistic_loss(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    return LG.total_logistic_loss(data, rows, _probe(data), LAM).select(r6("loss").alias("loss"))


@register("logistic_gradient", f"""{_BASE},
z AS {_z_sql('probe')}
SELECT feature, {s6('g')} AS gradient FROM {_grad_sql('probe', 'z')}""")
def logistic_gradient(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    out = LG.logistic_gradient(data, rows, _probe(data), LAM)
    return out.select("feature", r6("gradient").alias("gradient"))


@register("logistic_step", f"""{_BASE}{_step_sql(1, 'probe')}
SELECT {s6('(SELECT f FROM obj1)')} AS objective, {s6('(SELECT gg FROM nrm1)')} AS grad_norm_sq,
       {s6('t')} AS step, CAST(k AS INTEGER) AS k, {s6('f_after')} AS objective_after FROM step1""")
def logistic_step(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    out = LG.logistic_step(data, rows, _probe(data), LAM)
    return out.select(r6("objective").alias("objective"), r6("grad_norm_sq").alias("grad_norm_sq"),
                      r6("step").alias("step"), "k", r6("objective_after").alias("objective_after"))


def _train_sql(k: int) -> str:
    sql = f"""WITH {sparse_cte()},
b0 AS (SELECT feature, value FROM sparse WHERE false)"""
    for i in range(1, k + 1):
        sql += _step_sql(i, f"b{i - 1}")
        sql += f""",
b{i} AS MATERIALIZED (SELECT feature, b - (SELECT t FROM step{i}) * g AS value FROM g{i})"""
    return sql


@register(f"logistic_k{TRAIN_ITERS}", _train_sql(TRAIN_ITERS)
          + f"\nSELECT feature, {s6('value')} AS value FROM b{TRAIN_ITERS}")
def logistic_k2(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    fit = LG.train_logistic(data, rows, LAM, max_iter=TRAIN_ITERS, eps=0.0)
    return fit.beta.select("feature", r6("value").alias("value"))


@register(f"logistic_split_k{TRAIN_ITERS}", _train_sql(TRAIN_ITERS)
          + f"\nSELECT feature, {s6('value')} AS value FROM b{TRAIN_ITERS}")
def logistic_split_k2(spark, sf_dir):
    """The same training with nothing broadcast: examples in a grid of four
    blocks a side, features in over 200 rows dealt over all cells."""
    data, rows = _data(spark, sf_dir)
    fit = LG.train_logistic(data, rows, LAM, max_iter=TRAIN_ITERS, eps=0.0, broadcast_rows=0, side=4, hot_entries=200)
    return fit.beta.select("feature", r6("value").alias("value"))


@register(f"logistic_beta_history_k{TRAIN_ITERS}", _train_sql(TRAIN_ITERS) + "\n" + "\nUNION ALL\n".join(
    f"SELECT {i - 1}::INTEGER AS iteration, feature, {s6('value')} AS value FROM b{i}" for i in range(1, TRAIN_ITERS + 1)))
def logistic_beta_history(spark, sf_dir):
    """The model after every iteration, written during training and read back."""
    data, rows = _data(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/beta-{uuid.uuid4().hex}"
    LG.train_logistic(data, rows, LAM, max_iter=TRAIN_ITERS, eps=0.0, beta_path=path)
    return load_versions(spark, path).select("iteration", "feature", r6("value").alias("value"))


@register("binary_metrics", f"""{_BASE},
z AS {_z_sql('probe')},
c AS (SELECT count_if(z > 0 AND label = 1)::DOUBLE AS tp, count_if(z > 0 AND label <> 1)::DOUBLE AS fp,
             count_if(z <= 0 AND label <> 1)::DOUBLE AS tn, count_if(z <= 0 AND label = 1)::DOUBLE AS fn FROM z)
SELECT {s6('CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn) END')} AS accuracy,
       {s6('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END')} AS precision,
       {s6('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END')} AS recall FROM c""")
def binary_metrics(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    out = LG.binary_metrics(data, rows, _probe(data))
    return out.select(*[r6(c).alias(c) for c in ("accuracy", "precision", "recall")])


@register("sparse_numeric_gradient", f"""{_BASE},
z AS {_z_sql('probe')},
d AS (SELECT s.feature, sum({_loss(f'z.label * (z.z + {DELTA!r} * s.value)')} - {_loss('z.label * z.z')}) AS ds
      FROM sparse s JOIN z USING (row_id) GROUP BY s.feature)
SELECT p.feature, {s6(f'(coalesce(d.ds, 0.0) + {LAM!r} * (2 * {DELTA!r} * p.value + {DELTA * DELTA!r})) / {DELTA!r}')} AS gradient
FROM probe p LEFT JOIN d USING (feature)""")
def sparse_numeric_gradient(spark, sf_dir):
    data, rows = _data(spark, sf_dir)
    out = LG.numeric_gradient(data, rows, _probe(data), LAM, DELTA)
    return out.select("feature", r6("gradient").alias("gradient"))


def _metrics_sql(z: str) -> str:
    return f"""(SELECT (count_if(z > 0 AND label = 1) + count_if(z <= 0 AND label <> 1))::DOUBLE / nullif(count(*), 0) AS accuracy,
       count_if(z > 0 AND label = 1)::DOUBLE / nullif(count_if(z > 0), 0) AS precision,
       count_if(z > 0 AND label = 1)::DOUBLE / nullif(count_if(label = 1), 0) AS recall FROM {z})"""


def _history_sql(k: int) -> str:
    rows = [f"""SELECT {i - 1}::INTEGER AS iteration, {s6(f'(SELECT f FROM obj{i})')} AS objective,
       {s6(f'sqrt((SELECT gg FROM nrm{i}))')} AS grad_norm, {s6(f'(SELECT t FROM step{i})')} AS step,
       {s6('accuracy')} AS accuracy, {s6('precision')} AS precision, {s6('recall')} AS recall
FROM {_metrics_sql(_z_sql(f'b{i}'))}""" for i in range(1, k + 1)]
    return _train_sql(k) + "\n" + "\nUNION ALL\n".join(rows)


@register(f"logistic_history_k{TRAIN_ITERS}", _history_sql(TRAIN_ITERS))
def logistic_history(spark, sf_dir):
    """Training history (S13): one row per iteration with objective, gradient
    norm, step and test metrics (the training rows serve as test set).  The
    elapsed time, which is not reproducible, stays in ``LogisticFit.history``."""
    data, rows = _data(spark, sf_dir)
    fit = LG.train_logistic(data, rows, LAM, max_iter=TRAIN_ITERS, eps=0.0, test=(data, rows))
    names = ("objective", "grad_norm", "step", "accuracy", "precision", "recall")
    return fit.history_df(spark).select("iteration", *[r6(c).alias(c) for c in names])
