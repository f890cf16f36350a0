"""Matrix factorization of ratings by gradient descent, with k-fold
cross validation.

Ratings ``(user_id, item_id, rating)``; profiles ``(id, f0 .. f{d-1})`` as
flat double columns so that dot products and sums are code-generated.
Objective ``sum (<u_i, v_j> - r_ij)^2 + lam sum |u_i|^2 + mu sum |v_j|^2``.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..plans.grid import COL, ROW, SparseGrid
from ..plans.iterate import Materializer
from ..plans.joins import broadcast_if_bounded

# 48 bits for each uniform
UNIFORM = float(1 << 48)


def fcols(d: int, prefix: str = "f") -> list[str]:
    return [f"{prefix}{k}" for k in range(d)]


def hashed_normal(id_col: Column, k: int, salt: int) -> Column:
    """Standard normal value for (id, coordinate k) by Box-Muller on two
    uniforms, taken from separate parts of the md5 of id, coordinate and salt.
    Independent of partitioning, so retries and re-runs give the same profile."""
    m = F.md5(F.concat(id_col.cast("string"), F.lit(f":{k}:{salt}")).cast("binary"))
    u1 = (F.conv(F.substring(m, 1, 12), 16, 10).cast("double") + 1.0) / F.lit(UNIFORM)
    u2 = F.conv(F.substring(m, 13, 12), 16, 10).cast("double") / F.lit(UNIFORM)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def init_profiles(ratings: DataFrame, key: str, d: int, salt: int) -> DataFrame:
    """One random profile per distinct ``key`` value: ``(key, f0..)``."""
    ids = ratings.select(key).distinct()
    return ids.select(key, *[hashed_normal(F.col(key), k, salt).alias(c) for k, c in enumerate(fcols(d))])


def init_user_profiles(ratings, d: int = 10, seed: int = 1234567) -> DataFrame:
    return init_profiles(ratings, "user_id", d, seed)


def init_item_profiles(ratings, d: int = 10, seed: int = 1234567) -> DataFrame:
    # a different salt than users, so U and V are not copies of each other
    return init_profiles(ratings, "item_id", d, seed + 1)


def _dot(a: list[str], b: list[str]) -> Column:
    out = F.col(a[0]) * F.col(b[0])
    for x, y in zip(a[1:], b[1:]):
        out = out + F.col(x) * F.col(y)
    return out


def predict_ratings(ratings: DataFrame, U: DataFrame, V: DataFrame, d: int,
                    n_users: int | None = None, n_items: int | None = None) -> DataFrame:
    """``(user_id, item_id, delta, u0.., v0..)`` with ``delta = <u, v> - r``.

    Two equi-joins (ratings without a profile drop out).  A profile table is
    broadcast only when its exact size (counted, unless given) is bounded, and
    is joined last, so that the ratings do not move with its profiles;
    otherwise AQE chooses, splitting the partitions of very active users or
    items.
    """
    sides = []
    for P, key, letter, n in ((U, "user_id", "u", n_users), (V, "item_id", "v", n_items)):
        rows = P.select(key, *[F.col(f).alias(c) for f, c in zip(fcols(d), fcols(d, letter))])
        few = broadcast_if_bounded(rows, P.count() if n is None else n, row_bytes=8 * (d + 1))
        sides.append((few is not rows, key, few))
    j = ratings.select("user_id", "item_id", "rating")
    for _, key, rows in sorted(sides, key=lambda side: side[0]):
        j = j.join(rows, key)
    uc, vc = fcols(d, "u"), fcols(d, "v")
    return j.select("user_id", "item_id", (_dot(uc, vc) - F.col("rating")).alias("delta"), *uc, *vc)


def squared_error_total(joined: DataFrame) -> DataFrame:
    return joined.agg(F.coalesce(F.sum(F.col("delta") * F.col("delta")), F.lit(0.0)).alias("se"))


def profile_norm(P: DataFrame, d: int, weight: float) -> Column:
    """``weight * sum |p|^2`` as an aggregate expression over P."""
    return F.lit(weight) * F.coalesce(F.sum(_dot(fcols(d), fcols(d))), F.lit(0.0))


def _update(joined: DataFrame, key: str, own: list[str], other: list[str], gamma: float,
            reg: float, d: int) -> DataFrame:
    """``p - gamma (sum 2 delta q + 2 reg p)`` per key, one shuffle.

    The own profile is constant within the group, so ``any_value`` picks it;
    sums are partial-aggregated before the shuffle.
    """
    aggs = []
    for k, (p, q) in enumerate(zip(own, other)):
        g = F.sum(F.lit(2.0) * F.col("delta") * F.col(q))
        aggs.append((F.any_value(p) - F.lit(gamma) * (g + F.lit(2.0 * reg) * F.any_value(p))).alias(f"f{k}"))
    return joined.groupBy(key).agg(*aggs)


def update_users(joined: DataFrame, gamma: float, lam: float, d: int) -> DataFrame:
    return _update(joined, "user_id", fcols(d, "u"), fcols(d, "v"), gamma, lam, d)


def update_items(joined: DataFrame, gamma: float, mu: float, d: int) -> DataFrame:
    return _update(joined, "item_id", fcols(d, "v"), fcols(d, "u"), gamma, mu, d)


def rmse(test: DataFrame, U: DataFrame, V: DataFrame, d: int, n_users=None, n_items=None) -> DataFrame:
    """``(rmse, n_matched, n_test)``: RMSE over test ratings that have both
    profiles (cold-start rows are counted in n_test only)."""
    j = predict_ratings(test, U, V, d, n_users, n_items)
    n_test = test.agg(F.count(F.lit(1))).scalar()
    return j.agg(F.sqrt(F.try_divide(F.sum(F.col("delta") * F.col("delta")), F.count(F.lit(1)).cast("double")))
                 .alias("rmse"), F.count(F.lit(1)).alias("n_matched"), n_test.alias("n_test"))


def assign_folds(ratings: DataFrame, k: int) -> DataFrame:
    """``fold = (31 * user_id + item_id) mod k`` -- stable, no shuffle."""
    return ratings.withColumn("fold", F.pmod(F.col("user_id") * 31 + F.col("item_id"), F.lit(k)).cast("int"))


def gain_at(i: int, gain: float, power: float) -> float:
    return gain / i ** power


@dataclass
class MFFit:
    U: DataFrame
    V: DataFrame
    history: list = field(default_factory=list)

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(
            self.history, "iteration int, objective double, test_rmse double, n_matched long, "
                          "gamma double, elapsed_s double")


#: Fold number of a model that is trained on every rating.
NO_FOLD = -1
KINDS = {"user_id": ROW, "item_id": COL}


class GridModels:
    """Models of several folds, trained together on ratings in a grid.

    Model ``k`` learns from the ratings of all other folds and is tested on
    those of fold ``k``; model ``NO_FOLD`` learns from all and is tested on
    them too.  Its state is one table ``(kind, model, id, mask, f0 ..)`` of user
    and item profiles.  A step sends the profiles to the grid's cells, which
    answer with gradient sums per model, user and item and with the errors of
    the profiles they got: the ratings are read once per step, and the number
    of jobs does not depend on the number of models.
    """

    def __init__(self, ratings: DataFrame, models: list[int], d: int, lam: float, mu: float, seed: int,
                 side: int | None = None, hot_entries: int | None = None):
        self.spark, self.d, self.reg = ratings.sparkSession, d, {ROW: lam, COL: mu}
        self.mat = Materializer(self.spark)
        # equal ratings are one entry with a count, so a repeated one is no hot pair
        entries = self.mat(ratings.groupBy(F.col("user_id").cast("long").alias("row"), F.col("item_id").cast("long").alias("col"),
                                           F.col("rating").cast("double").alias("rating"), F.col("fold").cast("int").alias("fold"))
                           .agg(F.count(F.lit(1)).alias("times")).where("row is not null and col is not null and rating is not null"))
        self.grid = SparseGrid(entries, entries.count(), side, hot_entries)
        self.mat.release_all_but()
        self.state = self.mat(self._start(ROW, models, seed).unionByName(self._start(COL, models, seed + 1)))

    def _start(self, kind: int, models: list[int], salt: int) -> DataFrame:
        """First profiles: each model has those with a rating outside its fold."""
        ids = self.grid.masks(kind, F.min("fold").alias("_lo"), F.max("fold").alias("_hi"))
        per = ids.withColumn("model", F.explode(F.array(*map(F.lit, models)))).where(
            (F.col("model") != F.col("_lo")) | (F.col("model") != F.col("_hi")))
        return per.select(F.lit(kind).alias("kind"), "model", "id", "mask",
                          *[hashed_normal(F.col("id"), k, salt).alias(c) for k, c in enumerate(fcols(self.d))])

    def norms(self) -> dict[int, float]:
        """``lam sum |u|^2 + mu sum |v|^2`` per model."""
        f = fcols(self.d)
        weight = F.when(F.col("kind") == ROW, F.lit(float(self.reg[ROW]))).otherwise(F.lit(float(self.reg[COL])))
        rows = self.state.groupBy("model").agg(F.sum(weight * _dot(f, f)).alias("norm")).collect()  # one row a model
        return {r["model"]: r["norm"] for r in rows}

    def step(self, gamma: dict[int, float]) -> dict[int, tuple[float, int, float, int]]:
        """Update the models in ``gamma`` by their gains; returns each one's
        squared error and count on its training and on its test ratings, both
        of the profiles before the update."""
        f, g = fcols(self.d), fcols(self.d, "g")
        live = self.state.where(F.col("model").isin(list(gamma)))
        found = self.grid.answer(self.grid.sent(live), cell_step(sorted(gamma), self.d), _answer_schema(self.d))
        none = [F.lit(None).cast("double").alias(c) for c in g]
        errors = [F.lit(None).cast(kind).alias(c) for c, kind in ERRORS.items()]
        own = self.state.select("kind", "model", "id", "mask", *f, *none, *errors)
        back = found.select("kind", "model", "id", F.lit(None).cast("long").alias("mask"),
                            *[F.lit(None).cast("double").alias(c) for c in f], *g, *ERRORS)
        summed = own.unionByName(back).groupBy("kind", "model", "id").agg(
            F.max("mask").alias("mask"), *[F.max(c).alias(c) for c in f], *[F.sum(c).alias(c) for c in (*g, *ERRORS)])
        gain = F.coalesce(*[F.when(F.col("model") == m, F.lit(v)) for m, v in gamma.items()], F.lit(0.0))
        twice = F.when(F.col("kind") == ROW, F.lit(2.0 * self.reg[ROW])).otherwise(F.lit(2.0 * self.reg[COL]))
        moved = [(F.col(a) - gain * (F.coalesce(F.col(b), F.lit(0.0)) + twice * F.col(a))).alias(a) for a, b in zip(f, g)]
        new = self.mat(summed.select("kind", "model", "id", "mask", *moved, *ERRORS))
        rows = new.where(F.col("kind") == ERROR_ROWS).collect()  # one row a model
        self.state = new.where(F.col("kind") != ERROR_ROWS).select("kind", "model", "id", "mask", *f)
        self.mat.release_all_but(new)
        out = {m: (0.0, 0, 0.0, 0) for m in gamma}
        return out | {r["model"]: tuple(r[c] for c in ERRORS) for r in rows}

    def profiles(self, key: str, model: int = NO_FOLD) -> DataFrame:
        return (self.state.where((F.col("kind") == KINDS[key]) & (F.col("model") == model))
                .select(F.col("id").alias(key), *fcols(self.d)))

    def close(self) -> None:
        self.grid.close()


ERROR_ROWS = 2
ERRORS = {"se": "double", "n": "long", "test_se": "double", "test_n": "long"}


def _answer_schema(d: int) -> str:
    return ", ".join(["kind int", "model int", "id long", *(f"{c} double" for c in fcols(d, "g")),
                      *(f"{c} {kind}" for c, kind in ERRORS.items())])


def cell_step(models: list[int], d: int):
    """What one cell answers: per model, gradient sums of its users and items, and a row of errors."""
    names = ["kind", "model", "id", *fcols(d, "g"), *ERRORS]
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.float64()] * d, pa.float64(), pa.int64(), pa.float64(), pa.int64()]

    def part(kind: int, model: int, ids: np.ndarray, sums: list, errors: tuple | None = None) -> list[pa.Array]:
        n = len(ids)
        cols = [np.full(n, kind, np.int32), np.full(n, model, np.int32), ids, *sums]
        last = [pa.nulls(n, k) for k in kinds[-4:]] if errors is None else [pa.array([e], k) for e, k in zip(errors, kinds[-4:])]
        return [pa.array(c, k) for c, k in zip(cols, kinds)] + last

    def one(model: int, entries: pa.Table, values: pa.Table) -> list[list[pa.Array]]:
        users, items = (_profiles(values, kind, model, d) for kind in (ROW, COL))
        sums = [np.zeros((d, len(ids))) for ids, _ in (users, items)]
        errors = [0.0, 0, 0.0, 0]
        for at in range(0, entries.num_rows, STEP_ENTRIES):  # no profile is copied for more entries at once
            some = entries.slice(at, STEP_ENTRIES)
            row, col, rating, fold, times = (some[c].to_numpy() for c in ("row", "col", "rating", "fold", "times"))
            at_u, at_v = _places(users[0], row), _places(items[0], col)
            known = (at_u >= 0) & (at_v >= 0)
            at_u, at_v = at_u[known], at_v[known]
            pu, pv = users[1][at_u], items[1][at_v]
            delta = np.einsum("ij,ij->i", pu, pv) - rating[known]
            count, held = times[known], fold[known] == model
            square = count * delta * delta
            weight = np.where(held, 0.0, 2.0 * count * delta)
            for k in range(d):
                _add(sums[0][k], at_u, weight * pv[:, k])
                _add(sums[1][k], at_v, weight * pu[:, k])
            tested = held if model != NO_FOLD else np.ones(len(held), bool)
            more = square[~held].sum(), int(count[~held].sum()), square[tested].sum(), int(count[tested].sum())
            errors = [a + b for a, b in zip(errors, more)]
        return [part(ROW, model, users[0], list(sums[0])), part(COL, model, items[0], list(sums[1])),
                part(ERROR_ROWS, model, np.zeros(1, np.int64), [np.zeros(1)] * d, tuple(errors))]

    def run(entries: pa.Table, values: pa.Table) -> pa.Table:
        if not entries.num_rows or not values.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names)
        return pa.concat_tables(pa.Table.from_arrays(p, names) for model in models for p in one(model, entries, values))

    return run


#: Entries of a cell whose profiles are looked up at once.
STEP_ENTRIES = 1 << 16


def _profiles(values: pa.Table, kind: int, model: int, d: int) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, profiles)`` of one kind and model, in order of ids."""
    at = np.flatnonzero((values["kind"].to_numpy() == kind) & (values["model"].to_numpy() == model))
    ids = values["id"].to_numpy()[at]
    order = np.argsort(ids)
    at, f = at[order], np.empty((len(at), d))
    for k, c in enumerate(fcols(d)):  # a column at a time
        f[:, k] = values[c].to_numpy()[at]
    return ids[order], f


def _places(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key among sorted ids, or -1."""
    if not len(ids):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(ids, keys), len(ids) - 1)
    return np.where(ids[at] == keys, at, -1)


def _add(sums: np.ndarray, at: np.ndarray, more: np.ndarray) -> None:
    """Add ``more`` to ``sums`` at ``at``, which may repeat."""
    np.add.at(sums, at, more)


def train_models(ratings: DataFrame, models: list[int], d: int, gain: float, power: float, lam: float, mu: float,
                 max_iter: int, eps: float, seed: int, side: int | None = None,
                 hot_entries: int | None = None) -> tuple[GridModels, dict[int, list]]:
    """Train ``models`` on ``(user_id, item_id, rating, fold)``; their state, still open, and a history each.

    Iteration i: objective and test RMSE are measured on the current profiles,
    then users and items are updated by the gain ``gain / i^power``.  A model
    stops after ``max_iter`` iterations or when its objective changes by at
    most ``eps``; the others go on.
    """
    fit = GridModels(ratings, models, d, lam, mu, seed, side, hot_entries)
    history: dict[int, list] = {m: [] for m in models}
    objective = {m: 1e99 for m in models}
    active, i, start = list(models), 0, time.time()
    while active and i < max_iter:
        i += 1
        norms, gamma = fit.norms(), gain_at(i, gain, power)
        for m, (se, _, test_se, test_n) in fit.step({m: gamma for m in active}).items():
            old, objective[m] = objective[m], se + norms.get(m, 0.0)
            history[m].append((i, objective[m], math.sqrt(test_se / test_n) if test_n else None, test_n, gamma, time.time() - start))
            if abs(objective[m] - old) <= eps:
                active.remove(m)
    return fit, history


def train_mf(train: DataFrame, d: int = 10, gain: float = 0.001, power: float = 0.2,
             lam: float = 1.0, mu: float = 1.0, max_iter: int = 20, eps: float = 1e-99,
             seed: int = 1234567, test: DataFrame | None = None, side: int | None = None,
             hot_entries: int | None = None) -> MFFit:
    """Gradient descent from hashed-normal profiles (see ``train_models``).

    ``test`` ratings, if given, are those that the RMSE is measured on; they
    lie in the same grid, as the one fold that the model does not learn from.
    Ratings with a null id or value are left out.  ``side`` and ``hot_entries``
    are those of the grid.
    """
    model = NO_FOLD if test is None else 0
    ratings = train.select("user_id", "item_id", "rating", F.lit(1).alias("fold"))
    if test is not None:
        ratings = ratings.unionByName(test.select("user_id", "item_id", "rating", F.lit(0).alias("fold")))
    fit, history = train_models(ratings, [model], d, gain, power, lam, mu, max_iter, eps, seed, side, hot_entries)
    fit.close()
    return MFFit(fit.profiles("user_id", model), fit.profiles("item_id", model), history[model])


@dataclass
class CVResult:
    folds: list  # (fold, rmse, n_matched, n_test)

    @property
    def mean_rmse(self) -> float:
        vals = [f[1] for f in self.folds if f[1] is not None]
        return sum(vals) / len(vals) if vals else float("nan")

    def to_df(self, spark) -> DataFrame:
        rows = [(f, r, m, n, self.mean_rmse) for f, r, m, n in self.folds]
        return spark.createDataFrame(rows, "fold int, rmse double, n_matched long, n_test long, cv_rmse double")


def cross_validate(ratings_with_folds: DataFrame, k: int, d: int = 10, gain: float = 0.001, power: float = 0.2,
                   lam: float = 1.0, mu: float = 1.0, max_iter: int = 20, eps: float = 1e-99, seed: int = 1234567,
                   side: int | None = None, hot_entries: int | None = None) -> CVResult:
    """Leave-one-fold-out: train on the other folds, report the test RMSE of
    the last iteration (measured before its update, as in the reference).

    All folds are trained at once: the ratings are dealt to the grid once and
    read once per iteration, whatever ``k`` is.
    """
    ratings = ratings_with_folds.select("user_id", "item_id", "rating", "fold")
    fit, history = train_models(ratings, list(range(k)), d, gain, power, lam, mu, max_iter, eps, seed, side, hot_entries)
    sizes = {r["fold"]: r["n"] for r in fit.grid.entries.groupBy("fold").agg(F.sum("times").alias("n")).collect()}  # one row a fold
    fit.close()
    return CVResult([(f, *(history[f][-1][2:4] if history[f] else (None, 0)), sizes.get(f, 0)) for f in range(k)])


def fold_summary(ratings_with_folds: DataFrame) -> DataFrame:
    """Per fold k: ``(fold, n_train, n_test, n_users, n_items)`` of the
    leave-fold-k-out split, in one aggregate pass.

    Each rating is counted once as test (its own fold) and is train for
    every other fold; the distinct users/items of a training split are the
    ids that occur in any other fold, found from one (fold, id) table.
    """
    r = ratings_with_folds
    folds = r.select("fold").distinct()
    per_fold = r.groupBy("fold").agg(F.count(F.lit(1)).alias("n_test"))
    total = r.agg(F.count(F.lit(1))).scalar()

    def seen(key):
        # an id is in training for fold k unless all its ratings are in fold k
        by_id = r.groupBy(key).agg(F.count_distinct("fold").alias("_nf"), F.min("fold").alias("_only"))
        n_ids = by_id.agg(F.count(F.lit(1))).scalar()
        only_one = (by_id.where(F.col("_nf") == 1).groupBy(F.col("_only").alias("fold"))
                    .agg(F.count(F.lit(1)).alias("_lost")))
        return only_one, n_ids

    lost_u, n_u = seen("user_id")
    lost_i, n_i = seen("item_id")
    out = (folds.join(per_fold, "fold", "left")
           .join(lost_u.withColumnRenamed("_lost", "_lu"), "fold", "left")
           .join(lost_i.withColumnRenamed("_lost", "_li"), "fold", "left"))
    return out.select(F.col("fold").cast("int").alias("fold"),
                      (total - F.col("n_test")).alias("n_train"), "n_test",
                      (n_u - F.coalesce(F.col("_lu"), F.lit(0))).alias("n_users"),
                      (n_i - F.coalesce(F.col("_li"), F.lit(0))).alias("n_items"))


def fit_full(ratings: DataFrame, output: str | None = None, **train_args) -> MFFit:
    """Train on all ratings without cross validation (the "test" RMSE is
    measured on the training ratings) and, if ``output`` is given, write the
    profiles to ``{output}_U`` and ``{output}_V`` as parquet."""
    fit = train_mf(ratings, test=None, **train_args)
    if output:
        fit.U.write.mode("overwrite").parquet(f"{output}_U")
        fit.V.write.mode("overwrite").parquet(f"{output}_V")
    return fit
