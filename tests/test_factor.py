import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import factor as M


def test_single_update(spark):
    R = spark.createDataFrame([(1, 7, 1.0)], "user_id long, item_id long, rating double")
    U = spark.createDataFrame([(1, 1.0)], "user_id long, f0 double")
    V = spark.createDataFrame([(7, 2.0)], "item_id long, f0 double")
    j = M.predict_ratings(R, U, V, 1)
    assert j.first()["delta"] == 1.0
    assert M.update_users(j, 0.1, 0.0, 1).first()["f0"] == pytest.approx(0.6)
    assert M.update_items(j, 0.1, 0.0, 1).first()["f0"] == pytest.approx(1.8)


def test_init_is_deterministic_and_normal(spark):
    R = spark.range(2000).select(F.col("id").alias("user_id"), F.lit(1).cast("long").alias("item_id"),
                                 F.lit(1.0).alias("rating"))
    U1 = M.init_user_profiles(R.repartition(3), 4, 11)
    U2 = M.init_user_profiles(R.repartition(7), 4, 11)
    a = {r["user_id"]: tuple(r[1:]) for r in U1.collect()}
    b = {r["user_id"]: tuple(r[1:]) for r in U2.collect()}
    assert a == b
    vals = [v for t in a.values() for v in t]
    mean = sum(vals) / len(vals)
    var = sum((v - mean) ** 2 for v in vals) / len(vals)
    assert abs(mean) < 0.05 and abs(var - 1) < 0.1


def test_users_and_items_differ(spark):
    R = spark.createDataFrame([(1, 1, 1.0), (2, 2, 1.0)], "user_id long, item_id long, rating double")
    U = {r["user_id"]: r["f0"] for r in M.init_user_profiles(R, 2).collect()}
    V = {r["item_id"]: r["f0"] for r in M.init_item_profiles(R, 2).collect()}
    assert U[1] != V[1]


def test_training_lowers_objective(spark):
    rows = [(u, i, float((u * i) % 5) / 2) for u in range(1, 9) for i in range(1, 12) if (u + i) % 3]
    R = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    fit = M.train_mf(R, d=3, gain=0.01, power=0.2, lam=0.1, mu=0.1, max_iter=6)
    objs = [h[1] for h in fit.history]
    assert objs[-1] < objs[0]


def test_cross_validation(spark):
    rows = [(u, i, float((u + 2 * i) % 5) / 2) for u in range(1, 9) for i in range(1, 15)]
    R = M.assign_folds(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), 3)
    res = M.cross_validate(R, 3, d=2, gain=0.01, max_iter=2)
    assert len(res.folds) == 3
    assert sum(f[3] for f in res.folds) == len(rows)
    assert res.mean_rmse > 0


def test_fold_summary(spark):
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 3, 1.0)]
    R = spark.createDataFrame(rows, "user_id long, item_id long, rating double").withColumn(
        "fold", F.when(F.col("item_id") == 3, 1).otherwise(0))
    got = {r["fold"]: tuple(r[1:]) for r in M.fold_summary(R).collect()}
    assert got == {0: (1, 2, 1, 1), 1: (2, 1, 1, 2)}


def test_fit_full_writes_profiles(spark, tmp_dir):
    import os

    rows = [(u, i, float((u * i) % 4) / 2) for u in range(1, 5) for i in range(1, 6)]
    R = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    out = os.path.join(tmp_dir, "model")
    fit = M.fit_full(R, out, d=2, gain=0.01, max_iter=2)
    assert spark.read.parquet(out + "_U").count() == 4
    assert spark.read.parquet(out + "_V").count() == 5
    assert fit.history[-1][3] == len(rows)


def test_grid_of_one_cell_and_of_many_with_hot_users_and_items_agree(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 5)) for u in range(30) for i in range(40) if (u * i) % 3 or u == 0 or i == 0]
    rows += [rows[0]] * 4  # a repeated rating counts five times
    R = spark.createDataFrame(rows, "user_id long, item_id long, rating double").repartition(3)
    fits = [M.train_mf(R, d=3, gain=0.01, lam=0.1, mu=0.2, max_iter=4, side=side, hot_entries=hot)
            for side, hot in ((1, None), (4, None), (3, 25), (70, 10))]
    want = [{r[0]: tuple(round(x, 9) for x in r[1:]) for r in f.collect()} for f in (fits[0].U, fits[0].V)]
    assert len(want[0]) == 30 and len(want[1]) == 40
    for fit in fits[1:]:
        assert [{r[0]: tuple(round(x, 9) for x in r[1:]) for r in f.collect()} for f in (fit.U, fit.V)] == want
        assert [h[:5] for h in fit.history] == [pytest.approx(h[:5]) for h in fits[0].history]


def test_grid_step_is_the_gradient_of_the_joined_ratings(spark):
    rows = [(u, i, float((u + 2 * i) % 4)) for u in range(8) for i in range(9) if (u + i) % 2]
    R = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    U, V = M.init_user_profiles(R, 2), M.init_item_profiles(R, 2)
    joined = M.predict_ratings(R, U, V, 2)
    gamma = M.gain_at(1, 0.01, 0.2)
    want = {r[0]: r[1:] for r in M.update_users(joined, gamma, 0.3, 2).collect()}
    fit = M.train_mf(R, d=2, gain=0.01, power=0.2, lam=0.3, mu=0.4, max_iter=1)
    assert {r[0]: pytest.approx(r[1:]) for r in fit.U.collect()} == want
    assert fit.history[0][1] == pytest.approx(M.squared_error_total(joined).first()["se"] + U.agg(M.profile_norm(U, 2, 0.3)).first()[0]
                                              + V.agg(M.profile_norm(V, 2, 0.4)).first()[0])


def test_folds_trained_together_are_those_trained_alone(spark):
    rows = [(u, i, float((u * 5 + i) % 6)) for u in range(12) for i in range(10) if (u * i) % 4 != 1] + [(99, 1, 2.0)]
    F_ = M.assign_folds(spark.createDataFrame(rows, "user_id long, item_id long, rating double"), 3)
    got = M.cross_validate(F_, 3, d=2, gain=0.01, max_iter=3)
    for fold, rmse, matched, tested in got.folds:
        test = F_.where(f"fold = {fold}")
        alone = M.train_mf(F_.where(f"fold <> {fold}"), d=2, gain=0.01, max_iter=3, test=test)
        assert (rmse, matched) == (pytest.approx(alone.history[-1][2]), alone.history[-1][3]) and tested == test.count()


def test_an_iteration_does_not_shuffle_the_ratings(spark):
    R = spark.createDataFrame([(u, i, 1.0, 1) for u in range(6) for i in range(6)], "user_id long, item_id long, rating double, fold int")
    fit = M.GridModels(R, [M.NO_FOLD], 2, 1.0, 1.0, 7)
    plan = fit.grid.answer(fit.grid.sent(fit.state), M.cell_step([M.NO_FOLD], 2), M._answer_schema(2))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    fit.close()


def test_ratings_with_nulls_and_without_rows(spark):
    R = spark.createDataFrame([(1, 1, 2.0), (None, 1, 3.0), (2, None, 1.0), (2, 2, None)], "user_id long, item_id long, rating double")
    fit = M.train_mf(R, d=2, max_iter=2)
    assert [r[0] for r in fit.U.collect()] == [1] and fit.history[-1][3] == 1
    none = M.train_mf(R.where("false"), d=2, max_iter=2)
    assert none.U.collect() == [] and none.history[0][1:4] == (0.0, None, 0)


def test_a_cell_holds_profiles_of_few_entries_at_once():
    import tracemalloc

    import pyarrow as pa

    n, d, rng = 400_000, 10, np.random.default_rng(3)
    entries = pa.table({"row": rng.integers(0, 50, n), "col": rng.integers(0, 60, n), "rating": rng.random(n),
                        "fold": rng.integers(0, 2, n).astype("i4"), "times": np.ones(n, "i8")})
    values = pa.concat_tables(pa.table({"kind": np.full(k, kind, "i4"), "model": np.full(k, 0, "i4"), "id": rng.permutation(k),
                                        **{c: rng.standard_normal(k) for c in M.fcols(d)}}) for kind, k in ((0, 50), (1, 60)))
    tracemalloc.start()
    out = M.cell_step([0], d)(entries, values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6  # the profiles of all entries are 64 MB
    u, v = ({i: np.array([values[c][k].as_py() for c in M.fcols(d)]) for k, i in enumerate(values["id"].to_pylist())
             if values["kind"][k].as_py() == kind} for kind in (0, 1))
    row, col, rating, fold = (entries[c].to_numpy() for c in ("row", "col", "rating", "fold"))
    U, V = (np.array([p[k] for k in range(len(p))]) for p in (u, v))
    delta = np.einsum("ij,ij->i", U[row], V[col]) - rating
    rows = out.to_pylist()
    errors = next(r for r in rows if r["kind"] == M.ERROR_ROWS)
    assert abs(errors["se"] - (delta[fold != 0] ** 2).sum()) < 1e-6 * errors["se"] and errors["test_n"] == (fold == 0).sum()
    for r in rows[:3]:
        mine = (row == r["id"]) & (fold != 0)
        assert np.allclose([r[f"g{k}"] for k in range(d)], (2 * delta[mine, None] * V[col[mine]]).sum(axis=0))


def test_grid_shape_follows_rows_and_columns(spark):
    from tessera.plans import grid

    assert grid.grid_shape(400, 1000, 20_000) == (4, 100) and grid.grid_shape(16, 0, 0) == (4, 4) and grid.grid_shape(7, 10**9, 1) == (7, 1)
    entries = spark.range(4000).selectExpr("id % 20 as row", "id % 2000 as col", "1.0D as value")
    g = grid.SparseGrid(entries, 4000)
    assert g.blocks[grid.ROW] < g.blocks[grid.COL]
    for kind, key in ((grid.ROW, "row"), (grid.COL, "col")):
        sent = g.sent(g.masks(kind).withColumn("kind", F.lit(kind))).select("id", "cell").distinct()
        needed = g.entries.select(F.col(key).alias("id"), "cell").distinct()
        assert needed.exceptAll(sent).count() == 0
    g.close()


def test_a_given_side_grows_with_the_entries(spark, monkeypatch):
    from tessera.plans import grid

    monkeypatch.setattr(grid, "CELL_ENTRIES", 10)
    entries = spark.range(1000).selectExpr("id % 40 as row", "id % 77 as col", "1.0D as value")
    g = grid.SparseGrid(entries, 1000, side=2)
    assert g.blocks == {grid.ROW: 10, grid.COL: 10} and g.entries.count() == 1000
    g.close()


def test_small_profiles_are_broadcast_and_joined_last(spark, monkeypatch):
    from tessera.plans import joins

    R = spark.range(400).selectExpr("id % 5 as user_id", "id as item_id", "1.0D as rating")
    U, V = M.init_user_profiles(R, 2), M.init_item_profiles(R, 2)
    expected = {(r.user_id, r.item_id): r.delta for r in M.predict_ratings(R, U, V, 2).collect()}
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 5 * 24)  # bounds the users, not the items
    j = M.predict_ratings(R, U, V, 2)
    plan = j._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and "rightHint=(strategy=broadcast)" in plan.split("Join Inner")[1]  # the outer join
    got = {(r.user_id, r.item_id): r.delta for r in j.collect()}
    assert len(got) == 400 and got == pytest.approx(expected)
