import numpy as np
import pytest

from tessera.operators import linear as L


def data(spark, rows):
    return spark.createDataFrame(rows, "x1 double, y double")


def test_objective_and_gradient_at_zero(spark):
    df = data(spark, [(1.0, 2.0), (2.0, 4.0)])
    assert L.ridge_objective(df, ["x1"], "y", [0.0], 0.0).first()["objective"] == pytest.approx(10.0)
    assert L.ridge_gradient(df, ["x1"], "y", [0.0], 0.0).first()["gradient"] == pytest.approx(-10.0)


@pytest.mark.parametrize("lam,beta", [(0.0, 2.0), (1.0, 5 / 3.5)])
def test_train_ridge(spark, lam, beta):
    df = data(spark, [(1.0, 2.0), (2.0, 4.0)])
    fit = L.train_ridge(df, ["x1"], "y", lam, max_iter=1000, eps=1e-6)
    assert fit.beta[0] == pytest.approx(beta, abs=1e-6)
    assert fit.converged


def test_passes_path_matches_gram(spark):
    rows = [(float(i % 7), float(i % 3), float(2 * (i % 7) - (i % 3) + 0.1 * (i % 5))) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    g = L.train_ridge(df, ["a", "b"], "y", 0.5, max_iter=200, eps=1e-8)
    p = L.train_ridge_passes(df, ["a", "b"], "y", 0.5, max_iter=200, eps=1e-8)
    assert np.allclose(g.beta, p.beta, atol=1e-6)


def test_numeric_gradient_matches_analytic(spark):
    rows = [(float(i), float(i % 4), float(3 * i - (i % 4))) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    beta = [0.3, -0.2]
    an = {r["idx"]: r["gradient"] for r in L.ridge_gradient(df, ["a", "b"], "y", beta, 0.7).collect()}
    nu = {r["idx"]: r["gradient"] for r in L.numeric_gradient(df, ["a", "b"], "y", beta, 0.7, 1e-6).collect()}
    for i in an:
        assert nu[i] == pytest.approx(an[i], rel=1e-4, abs=1e-4)


def test_descent_never_raises_objective(spark):
    rows = [(float(i % 9), float(i % 5), float(i % 9) - 2 * float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    fit = L.train_ridge(df, ["a", "b"], "y", 0.1, max_iter=50, eps=1e-12)
    objs = [h[1] for h in fit.history]
    assert all(b <= a + 1e-12 for a, b in zip(objs, objs[1:]))


def test_matches_spark_ml_with_lambda_mapping(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    from pyspark.sql import functions as F

    rows = [(float(i % 11) / 10, float(i % 7) / 10, (i % 11) / 5 - (i % 7) / 20 + (i % 3) / 30) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    lam = 0.3
    ours = L.train_ridge(df, ["a", "b"], "y", lam, max_iter=10000, eps=1e-10).beta
    sd = df.agg(F.stddev_pop("y")).first()[0]  # the normal-equation solver scales by it
    va = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = LinearRegression(regParam=lam * sd, elasticNetParam=0.0, fitIntercept=False,
                             standardization=False, labelCol="y", tol=1e-12, maxIter=1000).fit(va)
    assert np.allclose(model.coefficients.toArray(), ours, atol=1e-4)


def test_lambda_sweep(spark):
    rows = [(float(i % 5), float(i % 5) * 2 + (i % 2), i % 4 == 0) for i in range(40)]
    df = spark.createDataFrame(rows, "x1 double, y double, is_test boolean")
    res = L.lambda_sweep(df, ["x1"], "y", "is_test", [0, 1, 2], max_iter=1000, eps=1e-9)
    betas = [r["beta"][0] for r in res]
    assert betas[0] > betas[1] > betas[2]
    assert all(r["test_mse"] is not None for r in res)


def test_gram_of_wide_data_in_blocks_and_slabs(spark):
    rng = np.random.default_rng(0)
    z = rng.normal(size=(300, 41))
    names = [f"v{k}" for k in range(40)] + ["y"]
    rows = [(*map(float, r), bool(k % 3 == 0) if k % 7 else None) for k, r in enumerate(z)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names) + ", part boolean").repartition(3)
    want = z.T @ z
    for block, slab in ((64, 1 << 20), (7, 1 << 20), (7, 1)):  # one block; blocks; a pass over the data per block
        got = L.Gram.from_cells(L.gram_cells(df, names[:-1], "y", block=block, slab_bytes=slab).collect(), 40)
        assert got.n == 300 and np.allclose(got.xx * 300, want[:40, :40]) and np.allclose(got.xy * 300, want[:40, 40])
    parts = L.gram_cells(df, names[:-1], "y", "part", block=16).collect()
    for key in (True, False, None):
        mine = np.array([r[-1] is key for r in rows])
        got = L.Gram.from_cells([r for r in parts if r["part"] is key], 40)
        assert got.n == mine.sum() and np.allclose(got.xx * got.n, z[mine][:, :40].T @ z[mine][:, :40])


def test_cells_of_nulls_and_narrow_data_agree(spark, monkeypatch):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (None, 1.0, 1.0), (2.0, None, None), (0.5, 0.5, 4.0)], "a double, b double, y double")
    one = L.gram(df, ["a", "b"], "y")
    monkeypatch.setattr(L, "GENERATED", 0)
    two = L.gram(df, ["a", "b"], "y")
    assert one.n == two.n and np.allclose(one.xx, two.xx) and np.allclose(one.xy, two.xy) and one.yy == pytest.approx(two.yy)


def test_prediction_of_many_columns(spark):
    n = 600
    df = spark.createDataFrame([tuple(float(k) for k in range(n))], ", ".join(f"v{k} double" for k in range(n)))
    cols = [f"v{k}" for k in range(n)]
    assert df.select(L.predict(cols, [1.0] * n).alias("p")).first()["p"] == n * (n - 1) / 2
