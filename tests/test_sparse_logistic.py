import math

import pytest

from tessera.operators import logistic as LG
from tessera.operators import sparse as V


def vec(spark, d):
    return spark.createDataFrame([(k, float(v)) for k, v in d.items()], "feature string, value double")


def as_dict(df, k="feature", v="value"):
    return {r[k]: r[v] for r in df.collect()}


def test_vector_ops(spark):
    a, b = vec(spark, {"x": 1, "y": 2}), vec(spark, {"y": 3, "z": 4})
    assert V.sparse_dot(a, b).first()["dot"] == 6.0
    assert as_dict(V.sparse_add(a, b)) == {"x": 1, "y": 5, "z": 4}
    assert as_dict(V.sparse_sub(a, b)) == {"x": 1, "y": -1, "z": -4}
    assert as_dict(V.sparse_scale(a, 2)) == {"x": 2, "y": 4}
    assert as_dict(V.sparse_sub(a, a)) == {"x": 0, "y": 0}


def test_sparse_get_missing_is_zero(spark):
    a = vec(spark, {"x": 1.5})
    keys = spark.createDataFrame([("x",), ("q",)], "feature string")
    assert as_dict(V.sparse_get(a, keys)) == {"x": 1.5, "q": 0.0}


def test_dot_without_shared_features(spark):
    assert V.sparse_dot(vec(spark, {"x": 1}), vec(spark, {"y": 1})).first()["dot"] == 0.0


def examples(spark, items):
    data = spark.createDataFrame([(i, y, f, float(v)) for i, (x, y) in enumerate(items) for f, v in x.items()],
                                 "row_id long, label int, feature string, value double")
    rows = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(items)], "row_id long, label int")
    return data, rows


def test_loss_and_gradient_at_empty_model(spark):
    data, rows = examples(spark, [({"f": 1}, 1), ({"f": 3}, -1)])
    beta = LG.empty_model(data)
    assert LG.total_logistic_loss(data, rows, beta, 0.0).first()["loss"] == pytest.approx(2 * math.log(2))
    assert as_dict(LG.logistic_gradient(data, rows, beta, 0.0), v="gradient") == pytest.approx({"f": 1.0})


def test_metrics(spark):
    # z = 1, -1, 0, 2 with y = +1, +1, -1, -1
    data, rows = examples(spark, [({"a": 1}, 1), ({"a": -1}, 1), ({"a": 0}, -1), ({"a": 2}, -1)])
    m = LG.binary_metrics(data, rows, vec(spark, {"a": 1.0})).first()
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.5, 0.5, 0.5)


def test_metrics_null_without_positives(spark):
    data, rows = examples(spark, [({"a": 1}, 1)])
    m = LG.binary_metrics(data, rows, vec(spark, {"a": -1.0})).first()
    assert m["precision"] is None


def test_numeric_gradient_matches_analytic(spark):
    items = [({"a": 1, "b": 0.5}, 1), ({"a": -0.5, "c": 2}, -1), ({"b": 1, "c": -1}, 1), ({}, -1)]
    data, rows = examples(spark, items)
    beta = vec(spark, {"a": 0.2, "b": -0.1, "c": 0.3})
    an = as_dict(LG.logistic_gradient(data, rows, beta, 0.5), v="gradient")
    nu = as_dict(LG.numeric_gradient(data, rows, beta, 0.5, 1e-6), v="gradient")
    for k in nu:
        assert nu[k] == pytest.approx(an[k], rel=1e-4, abs=1e-5)


def test_training_lowers_loss_and_keeps_featureless_rows(spark):
    items = [({"good": 1.0}, 1), ({"good": 0.8, "x": 0.2}, 1), ({"bad": 1.0}, -1), ({"bad": 0.5, "x": 0.5}, -1), ({}, 1)]
    data, rows = examples(spark, items)
    fit = LG.train_logistic(data, rows, lam=0.01, max_iter=5, eps=1e-6, test=(data, rows))
    objs = [h[1] for h in fit.history]
    assert all(b <= a for a, b in zip(objs, objs[1:]))
    assert LG.margins(data, rows, fit.beta).count() == 5
    b = as_dict(fit.beta)
    assert b["good"] > 0 > b["bad"]
    assert fit.history[-1][4] is not None


def _examples(spark):
    rows = [(i, 1 if i % 3 else -1) for i in range(40)]
    data = [(i, lab, f"f{j}", float((i * j) % 5) - 1.0) for i, lab in rows for j in range(8) if (i + j) % 3 and i != 7]
    data += [(i, lab, "everywhere", 1.0) for i, lab in rows] + [(3, -1, "twice", 0.5), (3, -1, "twice", 0.25)]
    return (spark.createDataFrame(data, "row_id long, label int, feature string, value double").repartition(3),
            spark.createDataFrame(rows, "row_id long, label int"))


def test_grid_and_broadcast_training_agree(spark):
    data, rows = _examples(spark)
    start = spark.createDataFrame([("f1", 0.3), ("elsewhere", -2.0)], "feature string, value double")
    for beta0 in (None, start):
        one = LG.train_logistic(data, rows, 0.2, max_iter=3, eps=0.0, beta0=beta0, test=(data, rows))
        for side, hot in ((None, None), (3, 5), (70, 3)):
            two = LG.train_logistic(data, rows, 0.2, max_iter=3, eps=0.0, beta0=beta0, test=(data, rows), broadcast_rows=0, side=side, hot_entries=hot)
            assert {r[0]: pytest.approx(r[1]) for r in two.beta.collect()} == {r[0]: r[1] for r in one.beta.collect()}
            assert [h[:7] for h in two.history] == [pytest.approx(h[:7]) for h in one.history]


def test_an_iteration_does_not_shuffle_the_examples(spark):
    from pyspark.sql import functions as F

    from tessera.plans.iterate import Materializer

    data, rows = _examples(spark)
    grid = LG.GridProducts(data, rows, LG.empty_model(data), Materializer(spark))
    plan = grid._product(grid.cols.select("id", "mask", F.col("b").alias("v")), 1)._jdf.queryExecution().executedPlan().toString()
    # the sent values and the answered sums move, the examples are read in buckets
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    grid.close()


def test_model_versions(spark, tmp_dir):
    from tessera.sources import models

    data, rows = _examples(spark)
    path = f"{tmp_dir}/beta"
    fit = LG.train_logistic(data, rows, 0.2, max_iter=3, eps=0.0, beta_path=path)
    last = {r[0]: r[1] for r in fit.beta.collect()}
    assert {r.iteration for r in models.load_versions(spark, path).select("iteration").distinct().collect()} == {0, 1, 2}
    assert {r[0]: r[1] for r in models.load_version(spark, path).collect()} == last
    first = {r[0]: r[1] for r in models.load_version(spark, path, 0).collect()}
    one = LG.train_logistic(data, rows, 0.2, max_iter=1, eps=0.0)
    assert first == {r[0]: pytest.approx(r[1]) for r in one.beta.collect()}
    moved = {r.iteration: (r.n_features, r.moved) for r in models.coefficient_changes(spark, path).collect()}
    assert moved[0] == (len(first), pytest.approx(sum(v * v for v in first.values()) ** .5)) and len(moved) == 3
    models.append_version(fit.beta.limit(2), path, 2)  # written again: replaced, not doubled
    assert models.load_version(spark, path, 2).count() == 2


def test_hot_features_and_rows_go_only_to_cells_that_hold_them(spark):
    from tessera.plans.grid import COL, ROW
    from tessera.plans.iterate import Materializer

    n, side = 60, 6
    rows = spark.createDataFrame([(i, 1 if i % 3 else -1) for i in range(n)], "row_id long, label int")
    data = spark.createDataFrame([(i, 1 if i % 3 else -1, f"f{(7 * i + j) % 40}", 1.0 + j) for i in range(n) for j in range(4)],
                                 "row_id long, label int, feature string, value double")
    grid = LG.GridProducts(data, rows, LG.empty_model(data), Materializer(spark), side=side, hot_entries=3)
    cols = {r.id: r.mask for r in grid.cols.collect()}
    # every feature is in 4 to 8 rows, over the bound of 3: at most 8 of the 36 cells hold it
    assert len(cols) == 40 and all(1 <= len(m) == len(set(m)) <= 8 for m in cols.values())
    # rows of 4 entries, over the bound too, lie in one row block: their cells are of one block
    assert all(len({c // side for c in r.mask}) == 1 for r in grid.rows.collect())
    sums = {r.id: r.s for r in grid._product(grid.rows.selectExpr("row_id as id", "mask", "1.0D as v"), ROW).collect()}
    assert set(sums) == set(cols) and sum(sums.values()) == 10.0 * n
    sums = {r.id: r.s for r in grid._product(grid.cols.selectExpr("id", "mask", "1.0D as v"), COL).collect()}
    assert sums == {i: 10.0 for i in range(n)}
    grid.close()


def test_repeated_entries_of_a_chunk_and_of_a_cell_add_up():
    import numpy as np
    import pyarrow as pa

    from tessera.plans import grid as G

    def batch(*entries):
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*entries), kinds)], ["cell", "row", "col", "x"])

    chunks = [pa.Table.from_batches(G._chunks([b])) for b in (batch((1, 5, 7, 1.0), (0, 2, 7, 4.0), (1, 5, 7, 2.0)), batch((1, 5, 7, 3.0), (1, 6, 7, 8.0)))]
    assert [c.num_rows for c in chunks] == [2, 1]
    both = pa.concat_tables(chunks)
    cell = G._packed_cell(both.filter(pa.compute.equal(both["cell"], 1)))
    assert np.frombuffer(cell["x"][0].as_py()).tolist() == [6.0, 8.0] and np.frombuffer(cell["rows"][0].as_py(), np.int64).tolist() == [5, 6]


def test_many_entries_are_packed_and_give_the_same_history(spark, monkeypatch):
    data, rows = _examples(spark)
    one = LG.train_logistic(data, rows, 0.2, max_iter=2, eps=0.0, test=(data, rows))
    monkeypatch.setattr(LG, "BROADCAST_ENTRIES", 10)
    made = []
    monkeypatch.setattr(LG, "GridProducts", lambda *a, f=LG.GridProducts: made.append(f(*a)) or made[-1])
    two = LG.train_logistic(data, rows, 0.2, max_iter=2, eps=0.0, test=(data, rows))
    assert len(made) == 1 and [h[:7] for h in two.history] == [pytest.approx(h[:7]) for h in one.history]
    assert {r[0]: pytest.approx(r[1]) for r in two.beta.collect()} == {r[0]: r[1] for r in one.beta.collect()}
