"""Registered matrix-factorization queries (M1-M13) over the ``ratings`` view."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import factor as M
from . import fixtures as fx
from .oracle_sql import RATINGS, r6 as s6
from .registry import r6, register

D = 10
SEED = 1234567
GAIN, POWER, LAM, MU = 0.001, 0.2, 1.0, 1.0
TRAIN_ITERS = 4
CV_FOLDS, CV_ITERS = 2, 2
FOLDS = 5


def _normal_sql(idc: str, k: int, salt: int) -> str:
    m = f"md5({idc}::VARCHAR || ':{k}:{salt}')"
    u1 = f"((('0x' || substr({m}, 1, 12))::BIGINT::DOUBLE + 1.0) / {M.UNIFORM!r})"
    u2 = f"(('0x' || substr({m}, 13, 12))::BIGINT::DOUBLE / {M.UNIFORM!r})"
    return f"sqrt(-2.0 * ln({u1})) * cos({2 * math.pi!r} * {u2})"


def _init_sql(src: str, key: str, salt: int) -> str:
    cols = ", ".join(f"{_normal_sql(key, k, salt)} AS f{k}" for k in range(D))
    return f"(SELECT {key}, {cols} FROM (SELECT DISTINCT {key} FROM {src}))"


def _dot_sql(a: str, b: str) -> str:
    return " + ".join(f"{a}.f{k} * {b}.f{k}" for k in range(D))


def _joined_sql(r: str, u: str, v: str) -> str:
    ucols = ", ".join(f"u.f{k} AS u{k}" for k in range(D))
    vcols = ", ".join(f"v.f{k} AS v{k}" for k in range(D))
    return (f"(SELECT r.user_id, r.item_id, ({_dot_sql('u', 'v')}) - r.rating AS delta, {ucols}, {vcols} "
            f"FROM {r} r JOIN {u} u USING (user_id) JOIN {v} v USING (item_id))")


def _update_sql(j: str, key: str, own: str, other: str, gamma: float, reg: float) -> str:
    cols = ", ".join(
        f"any_value({own}{k}) - {gamma!r} * (sum(2.0 * delta * {other}{k}) + {2.0 * reg!r} * any_value({own}{k})) AS f{k}"
        for k in range(D))
    return f"(SELECT {key}, {cols} FROM {j} GROUP BY {key})"


def _prof_out(key: str) -> str:
    return f"{key}, " + ", ".join(f"{s6(f'f{k}')} AS f{k}" for k in range(D))


def _prof_df(P_, key):
    return P_.select(key, *[r6(f"f{k}").alias(f"f{k}") for k in range(D)])


_BASE = f"""WITH r AS ({RATINGS}),
u0 AS MATERIALIZED {_init_sql('r', 'user_id', SEED)},
v0 AS MATERIALIZED {_init_sql('r', 'item_id', SEED + 1)},
j1 AS MATERIALIZED {_joined_sql('r', 'u0', 'v0')}"""


def _ratings(spark, sf_dir):
    return fx.ratings(spark, sf_dir)


def _init(spark, sf_dir):
    R = _ratings(spark, sf_dir)
    return R, M.init_user_profiles(R, D, SEED), M.init_item_profiles(R, D, SEED)


@register("mf_init_users", f"{_BASE} SELECT {_prof_out('user_id')} FROM u0")
def mf_init_users(spark, sf_dir):
    _, U, _ = _init(spark, sf_dir)
    return _prof_df(U, "user_id")


@register("mf_init_items", f"{_BASE} SELECT {_prof_out('item_id')} FROM v0")
def mf_init_items(spark, sf_dir):
    _, _, V = _init(spark, sf_dir)
    return _prof_df(V, "item_id")


@register("mf_residuals", f"{_BASE} SELECT user_id, item_id, {s6('delta')} AS delta FROM j1")
def mf_residuals(spark, sf_dir):
    R, U, V = _init(spark, sf_dir)
    j = M.predict_ratings(R, U, V, D)
    return j.select("user_id", "item_id", r6("delta").alias("delta"))


# A whole-table total of ~10^6 and more: 3 decimals keep 10 significant
# digits, well above the error from a different summation order.
@register("mf_squared_error", f"{_BASE} SELECT {s6('sum(delta * delta)', 3)} AS se FROM j1")
def mf_squared_error(spark, sf_dir):
    R, U, V = _init(spark, sf_dir)
    return M.squared_error_total(M.predict_ratings(R, U, V, D)).select(r6("se", 3).alias("se"))


@register("mf_profile_norm", f"""{_BASE}
SELECT {s6(f"{LAM!r} * (SELECT sum({_dot_sql('u0', 'u0')}) FROM u0)")} AS user_norm,
       {s6(f"{MU!r} * (SELECT sum({_dot_sql('v0', 'v0')}) FROM v0)")} AS item_norm""")
def mf_profile_norm(spark, sf_dir):
    _, U, V = _init(spark, sf_dir)
    item = V.agg(M.profile_norm(V, D, MU)).scalar()
    return U.agg(r6(M.profile_norm(U, D, LAM)).alias("user_norm"), r6(item).alias("item_norm"))


_G1 = M.gain_at(1, GAIN, POWER)


@register("mf_update_users", f"{_BASE} SELECT {_prof_out('user_id')} FROM {_update_sql('j1', 'user_id', 'u', 'v', _G1, LAM)}")
def mf_update_users(spark, sf_dir):
    R, U, V = _init(spark, sf_dir)
    return _prof_df(M.update_users(M.predict_ratings(R, U, V, D), _G1, LAM, D), "user_id")


@register("mf_update_items", f"{_BASE} SELECT {_prof_out('item_id')} FROM {_update_sql('j1', 'item_id', 'v', 'u', _G1, MU)}")
def mf_update_items(spark, sf_dir):
    R, U, V = _init(spark, sf_dir)
    return _prof_df(M.update_items(M.predict_ratings(R, U, V, D), _G1, MU, D), "item_id")


def _train_sql(r: str, k: int, tag: str = "") -> str:
    """CTEs ``{tag}u0..{tag}u{k}`` / ``{tag}v..`` / ``{tag}j1..{tag}j{k}`` (training on ``r``)."""
    parts = [f"{tag}u0 AS MATERIALIZED {_init_sql(r, 'user_id', SEED)}",
             f"{tag}v0 AS MATERIALIZED {_init_sql(r, 'item_id', SEED + 1)}"]
    for i in range(1, k + 1):
        g = M.gain_at(i, GAIN, POWER)
        parts.append(f"{tag}j{i} AS MATERIALIZED {_joined_sql(r, f'{tag}u{i - 1}', f'{tag}v{i - 1}')}")
        parts.append(f"{tag}u{i} AS MATERIALIZED {_update_sql(f'{tag}j{i}', 'user_id', 'u', 'v', g, LAM)}")
        parts.append(f"{tag}v{i} AS MATERIALIZED {_update_sql(f'{tag}j{i}', 'item_id', 'v', 'u', g, MU)}")
    return ",\n".join(parts)


@register(f"mf_k{TRAIN_ITERS}", f"WITH r AS ({RATINGS}),\n{_train_sql('r', TRAIN_ITERS)}\n"
          f"SELECT {_prof_out('user_id')} FROM u{TRAIN_ITERS}")
def mf_k4(spark, sf_dir):
    fit = M.train_mf(_ratings(spark, sf_dir), D, GAIN, POWER, LAM, MU, max_iter=TRAIN_ITERS, seed=SEED)
    return _prof_df(fit.U, "user_id")


@register(f"mf_k{TRAIN_ITERS}_items", f"WITH r AS ({RATINGS}),\n{_train_sql('r', TRAIN_ITERS)}\n"
          f"SELECT {_prof_out('item_id')} FROM v{TRAIN_ITERS}")
def mf_k4_items(spark, sf_dir):
    """Item profiles of the same training without folds, by ``fit_full``."""
    fit = M.fit_full(_ratings(spark, sf_dir), d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU, max_iter=TRAIN_ITERS, seed=SEED)
    return _prof_df(fit.V, "item_id")


@register(f"mf_hot_k{TRAIN_ITERS}", f"WITH r AS ({RATINGS}),\n{_train_sql('r', TRAIN_ITERS)}\n"
          f"SELECT {_prof_out('user_id')} FROM u{TRAIN_ITERS}")
def mf_hot_k4(spark, sf_dir):
    """The same training in a grid of five blocks a side (more where cells would be too full) whose users of over
    50 ratings, and items, are dealt over all cells."""
    fit = M.train_mf(_ratings(spark, sf_dir), D, GAIN, POWER, LAM, MU, max_iter=TRAIN_ITERS, seed=SEED, side=5, hot_entries=50)
    return _prof_df(fit.U, "user_id")


@register("fold_sizes", f"""WITH r AS ({RATINGS})
SELECT CAST((31 * user_id + item_id) % {FOLDS} AS INTEGER) AS fold, count(*) AS n_ratings FROM r GROUP BY fold""")
def fold_sizes(spark, sf_dir):
    f = fx.rating_folds(spark, sf_dir, FOLDS)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_ratings"))


def _rmse_sql(test: str, u: str, v: str) -> str:
    return (f"(SELECT sqrt(sum(delta * delta) / count(*)) AS rmse, count(*) AS n_matched, "
            f"(SELECT count(*) FROM {test}) AS n_test FROM {_joined_sql(test, u, v)})")


@register("mf_rmse", f"""WITH r AS ({RATINGS}),
rf AS (SELECT *, (31 * user_id + item_id) % {FOLDS} AS fold FROM r),
tr AS (SELECT user_id, item_id, rating FROM rf WHERE fold <> 0),
te AS (SELECT user_id, item_id, rating FROM rf WHERE fold = 0),
u0 AS MATERIALIZED {_init_sql('tr', 'user_id', SEED)},
v0 AS MATERIALIZED {_init_sql('tr', 'item_id', SEED + 1)}
SELECT {s6('rmse')} AS rmse, n_matched, n_test FROM {_rmse_sql('te', 'u0', 'v0')}""")
def mf_rmse(spark, sf_dir):
    """Test RMSE of the initial profiles on fold 0 (trained folds 1-4)."""
    f = fx.rating_folds(spark, sf_dir, FOLDS)
    tr, te = f.where(F.col("fold") != 0), f.where(F.col("fold") == 0)
    out = M.rmse(te, M.init_user_profiles(tr, D, SEED), M.init_item_profiles(tr, D, SEED), D)
    return out.select(r6("rmse").alias("rmse"), "n_matched", "n_test")


def _cv_sql() -> str:
    parts = [f"r AS ({RATINGS})",
             f"rf AS (SELECT *, (31 * user_id + item_id) % {CV_FOLDS} AS fold FROM r)"]
    sel = []
    for f in range(CV_FOLDS):
        parts.append(f"tr{f} AS (SELECT user_id, item_id, rating FROM rf WHERE fold <> {f})")
        parts.append(f"te{f} AS (SELECT user_id, item_id, rating FROM rf WHERE fold = {f})")
        parts.append(_train_sql(f"tr{f}", CV_ITERS - 1, tag=f"f{f}"))
        # the last history row is measured before the last update
        sel.append(f"SELECT {f} AS fold, rmse, n_matched, n_test FROM "
                   f"{_rmse_sql(f'te{f}', f'f{f}u{CV_ITERS - 1}', f'f{f}v{CV_ITERS - 1}')}")
    return ("WITH " + ",\n".join(parts) + ",\nfolds AS (" + " UNION ALL ".join(sel) + ")\n"
            f"SELECT CAST(fold AS INTEGER) AS fold, {s6('rmse')} AS rmse, n_matched, n_test, "
            f"{s6('avg(rmse) OVER ()')} AS cv_rmse FROM folds")


@register("mf_cv", _cv_sql())
def mf_cv(spark, sf_dir):
    f = fx.rating_folds(spark, sf_dir, CV_FOLDS)
    res = M.cross_validate(f, CV_FOLDS, d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU,
                           max_iter=CV_ITERS, seed=SEED)
    df = res.to_df(spark)
    return df.select("fold", r6("rmse").alias("rmse"), "n_matched", "n_test", r6("cv_rmse").alias("cv_rmse"))


@register("ratings_summary", f"""WITH r AS ({RATINGS}),
rf AS (SELECT *, (31 * user_id + item_id) % {FOLDS} AS fold FROM r),
ks AS (SELECT DISTINCT fold AS k FROM rf)
SELECT CAST(k AS INTEGER) AS fold, count_if(fold <> k) AS n_train, count_if(fold = k) AS n_test,
       count(DISTINCT CASE WHEN fold <> k THEN user_id END) AS n_users,
       count(DISTINCT CASE WHEN fold <> k THEN item_id END) AS n_items
FROM ks, rf GROUP BY k""")
def ratings_summary(spark, sf_dir):
    """Per fold k: train/test sizes and the users and items seen in training."""
    f = fx.rating_folds(spark, sf_dir, FOLDS)
    return M.fold_summary(f)
