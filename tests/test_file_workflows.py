"""The other tools, file to file: graphs, ridge, logistic, matrix factorization."""

import os

import pytest

from tessera.operators import factor as M
from tessera.operators import graph as G
from tessera.operators import linear as L
from tessera.operators import logistic as LG
from tessera.sources import readers as S
from tessera.sources import writers as W


def write(path, lines):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_graph_files(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "g1.txt"), ["(1, 2)", "(2, 3)", "(3, 1)", "(3, 4)"])
    q = write(os.path.join(tmp_dir, "g2.txt"), ["(10, 20)", "(20, 30)", "(30, 10)", "(30, 40)"])
    e1, e2 = S.read_edges(spark, p), S.read_edges(spark, q)
    res = G.pagerank(e1)
    W.write_tuples(res.scores.orderBy("score", ascending=False), os.path.join(tmp_dir, "pr"), fmt="text")
    assert len(os.listdir(os.path.join(tmp_dir, "pr"))) > 0
    assert {r["id"]: r["degree"] for r in G.degree(e1).collect()} == {1: 2, 2: 2, 3: 3, 4: 1}
    colors = G.joint_colors(e1, e2)
    assert G.compare_colorings(colors).first()["verdict"] in ("isomorphic", "maybe isomorphic")
    assert {r["node_1"]: r["node_2"] for r in G.node_mapping(colors).collect()}.get(4) == 40


def test_ridge_files(spark, tmp_dir):
    rows = [f"{i / 10},{(i % 3) / 10},{2 * i / 10 - (i % 3) / 10}" for i in range(30)]
    train = write(os.path.join(tmp_dir, "train.csv"), rows[:20])
    test = write(os.path.join(tmp_dir, "test.csv"), rows[20:])
    df = S.read_dense(spark, train)
    fit = L.train_ridge(df, ["x0", "x1"], "y", 0.0, max_iter=5000, eps=1e-8)
    W.save_dense_model(spark, fit.beta, os.path.join(tmp_dir, "beta"))
    beta = S.load_dense_model(spark, os.path.join(tmp_dir, "beta"))
    assert beta == pytest.approx([2.0, -1.0], abs=1e-4)
    assert L.mse(S.read_dense(spark, test), ["x0", "x1"], "y", beta).first()["mse"] < 1e-6


def test_logistic_files(spark, tmp_dir):
    lines = ['({"good": 1.0, "x": 0.5}, 1)', '({"good": 0.7}, 1)', '({"bad": 1.0, "x": 0.5}, -1)', '({"bad": 0.4}, -1)']
    p = write(os.path.join(tmp_dir, "train.txt"), lines)
    data, rows = S.read_sparse(spark, p)
    fit = LG.train_logistic(data, rows, 0.0, max_iter=10, eps=0.1, test=(data, rows))
    W.save_sparse_model(fit.beta, os.path.join(tmp_dir, "beta"))
    W.save_history(fit.history_df(spark), os.path.join(tmp_dir, "history"))
    beta = S.load_sparse_model(spark, os.path.join(tmp_dir, "beta"))
    m = LG.binary_metrics(data, rows, beta).first()
    assert m["accuracy"] == 1.0
    assert spark.read.parquet(os.path.join(tmp_dir, "history")).count() == fit.iterations


def test_matrix_factorization_folds(spark, tmp_dir):
    d = os.path.join(tmp_dir, "folds")
    os.makedirs(d)
    ratings = [(u, i, (u * i) % 5 / 2) for u in range(1, 7) for i in range(1, 9)]
    for k in range(3):
        write(os.path.join(d, f"fold{k}"), [f"{u},{i},{r}" for u, i, r in ratings if (u + i) % 3 == k])
    folds = S.read_folds(spark, d, 3)
    res = M.cross_validate(folds, 3, d=2, gain=0.01, max_iter=2)
    assert [f[0] for f in res.folds] == [0, 1, 2]
    assert sum(f[3] for f in res.folds) == len(ratings)
