"""A key holding a third of all rows: results must not depend on whether the
per-key side is broadcast or both sides are shuffled with skewed partitions
split by AQE."""

import pytest

from tessera.operators import graph as G
from tessera.operators import logistic as LG
from tessera.plans import joins

SHUFFLE_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
}


@pytest.fixture()
def shuffle_only(spark, monkeypatch):
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_ONLY}
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hub_edges(spark):
    # node 0 is an endpoint of a third of all edges
    e = [(0, i) for i in range(1, 101)] + [(i, i % 200 + 1) for i in range(1, 201)]
    return spark.createDataFrame(e, "src long, dst long")


def run_graph(spark):
    e = hub_edges(spark)
    pr = {r["id"]: round(r["score"], 12) for r in G.pagerank(e, 0.15, 5, 0.0).scores.collect()}
    wl = sorted(r["color"] for r in G.wl_colors(e, 4).collect())
    return pr, wl


def test_hub_graph_same_with_and_without_broadcast(spark, shuffle_only):
    skewed = run_graph(spark)
    plan = G.wl_refine(G._undirected(hub_edges(spark), ()),
                       G.graph_nodes(hub_edges(spark)).selectExpr("id", "'1' AS color"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in text
    assert len(skewed[0]) == 201


def test_hub_graph_matches_broadcast_path(spark, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 2_000_000)
    broadcast = run_graph(spark)
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.set(k, v)
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    try:
        shuffled = run_graph(spark)
    finally:
        from tessera.session import apply_recommended
        apply_recommended(spark)
        for k in ("spark.sql.adaptive.skewJoin.skewedPartitionFactor",
                  "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(k)
    assert shuffled[1] == broadcast[1]
    assert shuffled[0] == pytest.approx(broadcast[0], abs=1e-12)


def test_hot_feature_gradient(spark, shuffle_only):
    # one feature appears in every row
    items = [({"hot": 1.0, f"f{i}": 0.5}, 1 if i % 3 else -1) for i in range(60)]
    data = spark.createDataFrame([(i, y, f, float(v)) for i, (x, y) in enumerate(items) for f, v in x.items()],
                                 "row_id long, label int, feature string, value double")
    rows = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(items)], "row_id long, label int")
    beta = spark.createDataFrame([("hot", 0.1), ("f1", 0.2)], "feature string, value double")
    g = {r["feature"]: r["gradient"] for r in LG.logistic_gradient(data, rows, beta, 0.1).collect()}
    import math
    expected = sum(-y / (1 + math.exp(y * (0.1 + (0.1 if i == 1 else 0.0)))) for i, (_, y) in enumerate(items)) + 2 * 0.1 * 0.1
    assert g["hot"] == pytest.approx(expected)


def test_pagerank_copartitioned_path(spark, monkeypatch):
    """Above the broadcast bound PageRank co-partitions cold edges by source
    and broadcasts only the scores of hot sources; results are unchanged."""
    e = hub_edges(spark)
    expected = {r["id"]: r["score"] for r in G.pagerank(e, 0.15, 5, 0.0).scores.collect()}
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "MIN_HOT_DEGREE", 50)   # node 0 (100 targets) is hot
    res = G.pagerank(e, 0.15, 5, 0.0)
    got = {r["id"]: r["score"] for r in res.scores.collect()}
    assert got == pytest.approx(expected, abs=1e-12)


def test_wl_bucketed_path(spark, monkeypatch):
    """Above the broadcast bound WL buckets the adjacency by neighbour and
    broadcasts only the colours of hot neighbours; colours are unchanged."""
    e = hub_edges(spark)
    expected = sorted((r["id"], r["color"]) for r in G.wl_colors(e, 4).collect())
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins, "MIN_HOT_DEGREE", 50)   # node 0 (100+ neighbours) is hot
    got = sorted((r["id"], r["color"]) for r in G.wl_colors(e, 4).collect())
    assert got == expected
    joint = G.compare_graphs(e, e.selectExpr("src * 7 AS src", "dst * 7 AS dst"), 4).first()
    assert joint["verdict"] in ("isomorphic", "maybe isomorphic")


@pytest.mark.parametrize("hot_degree", [50, 20])
def test_salted_path_of_wide_ids(spark, monkeypatch, hot_degree):
    """Hot keys whose measured bytes are beyond the broadcast bound are joined
    by key and salt; results are unchanged."""
    e = hub_edges(spark).selectExpr("concat(repeat('x', 300), src) AS src", "concat(repeat('x', 300), dst) AS dst")
    e = e.unionAll(e.where("src like '%x0'"))  # repeated edges
    ranks = {r["id"]: r["score"] for r in G.pagerank(e, 0.15, 4, 0.0).scores.collect()}
    colors = sorted((r["id"], r["color"]) for r in G.wl_colors(e, 3).collect())
    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 100)
    monkeypatch.setattr(joins, "MIN_HOT_DEGREE", hot_degree)
    made = []
    init = joins.SkewSplitTable.__init__

    def keep(self, *args, **kwargs):
        init(self, *args, **kwargs)
        made.append((self.salted, self.n_hot))

    monkeypatch.setattr(joins.SkewSplitTable, "__init__", keep)
    assert {r["id"]: r["score"] for r in G.pagerank(e, 0.15, 4, 0.0).scores.collect()} == pytest.approx(ranks, abs=1e-12)
    assert sorted((r["id"], r["color"]) for r in G.wl_colors(e, 3).collect()) == colors
    assert len(made) == 2 and all(salted and n for salted, n in made)


def test_salted_join_reads_the_large_table_in_buckets(spark, monkeypatch):
    from tessera.plans.iterate import Materializer

    monkeypatch.setattr(joins, "MAX_BROADCAST_BYTES", 100)
    monkeypatch.setattr(joins, "MIN_HOT_DEGREE", 50)
    mat = Materializer(spark)
    fact = mat(hub_edges(spark))
    table = joins.SkewSplitTable(fact, ["src"], mat, fact.count(), 1000)
    per_key = G.graph_nodes(fact).selectExpr("id AS src", "id * 2 AS v")
    got = table.join(per_key)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 2 and "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, got.select("src", "dst", "v").collect())) == sorted((r.src, r.dst, 2 * r.src) for r in fact.collect())
    table.close()
