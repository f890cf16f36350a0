import pytest

from tessera.operators import graph as G


def edges(spark, pairs, typ="string"):
    return spark.createDataFrame(pairs, f"src {typ}, dst {typ}")


def scores(res):
    return {r["id"]: r["score"] for r in res.scores.collect()}


def test_pagerank_two_iterations(spark):
    res = G.pagerank(edges(spark, [("a", "b"), ("b", "c"), ("c", "b")]), 0.15, max_iter=2, eps=0.0)
    s = scores(res)
    assert s["a"] == pytest.approx(0.05)
    assert s["b"] == pytest.approx(0.333333, abs=1e-6)
    assert s["c"] == pytest.approx(0.574167, abs=1e-6)


def test_pagerank_cycle_stops_after_one(spark):
    res = G.pagerank(edges(spark, [("a", "b"), ("b", "c"), ("c", "a")]), 0.15, max_iter=50, eps=0.01)
    assert len(res.history) == 1
    assert all(v == pytest.approx(1 / 3) for v in scores(res).values())


def test_pagerank_single_edge(spark):
    res = G.pagerank(edges(spark, [("a", "b")]), 0.15)
    assert res.history == [(1, 0.0)]
    assert scores(res) == pytest.approx({"a": 0.075, "b": 0.5})


def test_pagerank_dag_runs_out(spark):
    res = G.pagerank(edges(spark, [("a", "b"), ("a", "c")]), 0.15)
    assert [i for i, _ in res.history] == [1, 2]
    assert res.history[0][1] == pytest.approx(0.283333, abs=1e-6)
    assert res.history[1][1] == 0.0
    assert scores(res) == pytest.approx({"a": 0.05, "b": 0.05, "c": 0.05})


def test_pagerank_sums_to_one_when_strongly_connected(spark):
    e = [(i, (i + 1) % 7) for i in range(7)] + [(i, (i + 3) % 7) for i in range(7)]
    res = G.pagerank(edges(spark, e, "long"), 0.15, max_iter=30, eps=1e-9)
    assert sum(scores(res).values()) == pytest.approx(1.0)


def test_degree_counts_loops_twice(spark):
    d = {r["id"]: r["degree"] for r in G.degree(edges(spark, [(1, 1), (1, 2), (1, 2)], "long")).collect()}
    assert d == {1: 4, 2: 2}


def test_out_links_weights(spark):
    w = {(r["src"], r["dst"]): r["w"] for r in G.out_links(edges(spark, [(1, 2), (1, 2), (1, 3)], "long")).collect()}
    assert w == pytest.approx({(1, 2): 2 / 3, (1, 3): 1 / 3})


def cycle(n, offset=0):
    return [(offset + i, offset + (i + 1) % n) for i in range(n)]


def verdict(spark, a, b):
    return G.compare_graphs(edges(spark, a, "long"), edges(spark, b, "long")).first()["verdict"]


def test_wl_cannot_separate_regular_graphs(spark):
    assert verdict(spark, cycle(6), cycle(3) + cycle(3, 10)) == "maybe isomorphic"


def test_wl_path_vs_triangle(spark):
    assert verdict(spark, [(1, 2), (2, 3)], cycle(3)) == "not isomorphic"


def test_wl_relabelled_is_isomorphic_and_mapped(spark):
    g = [(1, 2), (2, 3), (3, 4), (2, 5), (5, 6), (6, 7), (7, 8)]
    h = [(a * 7919 + 13, b * 7919 + 13) for a, b in g]
    e1, e2 = edges(spark, g, "long"), edges(spark, h, "long")
    colors = G.joint_colors(e1, e2)
    res = G.compare_colorings(colors).first()
    assert res["verdict"] in ("isomorphic", "maybe isomorphic")
    mapping = {r["node_1"]: r["node_2"] for r in G.node_mapping(colors).collect()}
    for a, b in mapping.items():
        assert b == a * 7919 + 13


def test_wl_colors_invariant_under_relabelling(spark):
    g = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5)]
    c1 = sorted(r["color"] for r in G.wl_colors(edges(spark, g, "long")).collect())
    c2 = sorted(r["color"] for r in G.wl_colors(edges(spark, [(b * 3, a * 3) for a, b in g], "long")).collect())
    assert c1 == c2


def test_color_distribution(spark):
    colors = G.wl_colors(edges(spark, [(1, 2), (2, 3)], "long"))
    dist = {r["class_size"]: r["n_classes"] for r in G.color_distribution(colors).collect()}
    assert dist == {2: 1, 1: 1}


def test_standard_pagerank_keeps_mass(spark):
    # a -> b, b -> c, c dangling: the textbook variant keeps total mass 1
    res = G.pagerank(edges(spark, [("a", "b"), ("b", "c")]), 0.15, max_iter=100, eps=1e-12, mode="standard")
    s = scores(res)
    assert sum(s.values()) == pytest.approx(1.0)
    assert s["c"] > s["b"] > s["a"]


def test_nodes_without_edges(spark):
    e = edges(spark, [("a", "b"), ("b", "a"), ("b", "b")])
    nodes = spark.createDataFrame([("a",), ("x",), ("y",), ("y",)], "id string")
    assert G.node_count(e, nodes).first()[0] == 4
    assert {r["id"]: r["degree"] for r in G.degree(e, nodes).collect()} == {"a": 2, "b": 4, "x": 0, "y": 0}
    ranks = scores(G.pagerank(e, 0.2, max_iter=3, eps=0.0, nodes=nodes))
    assert ranks["x"] == ranks["y"] == pytest.approx(0.05) and set(ranks) == {"a", "b", "x", "y"}
    standard = scores(G.pagerank(e, 0.2, max_iter=3, eps=0.0, mode="standard", nodes=nodes))
    assert sum(standard.values()) == pytest.approx(1.0)
    colors = {r["id"]: r["color"] for r in G.wl_colors(e, nodes=nodes).collect()}
    assert colors["x"] == colors["y"] and len(set(colors.values())) == 3
    split = {r["id"]: r["color"] for r in G.wl_colors(e, nodes=nodes, broadcast_rows=0).collect()}
    assert split == colors


def test_graphs_that_differ_in_nodes_without_edges(spark):
    e = edges(spark, [("a", "b"), ("b", "c")])
    one, two = (spark.createDataFrame(rows, "id string") for rows in ([("x",)], [("x",), ("y",)]))
    assert G.compare_graphs(e, e, nodes1=one, nodes2=two).first()["verdict"] == "not isomorphic"
    assert G.compare_graphs(e, e, nodes1=one, nodes2=one).first()["verdict"] == "maybe isomorphic"
