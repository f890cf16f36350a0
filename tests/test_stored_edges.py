"""Colour refinement keeps its edges as one compressed table."""

import glob

from tessera.operators import graph as G
from tessera.plans import iterate
from tessera.session import ensure_checkpoint_dir


def test_the_adjacency_is_not_checkpointed(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (1, 2), (2, 3), (3, 3), (None, 4), (5, None)], "src long, dst long")
    kept, found = [], []
    store = iterate.Materializer.__call__
    monkeypatch.setattr(iterate.Materializer, "__call__", lambda self, df: kept.append(df.columns) or store(self, df))
    for rows in (None, 0):
        kept.clear()
        colors = {r["id"]: r["color"] for r in G.wl_colors(edges, 2, broadcast_rows=rows).collect()}
        # without broadcast only the edges of hot nodes are, here none
        assert sum({"node", "nbr"} <= set(c) for c in kept) == (rows == 0)
        found.append(colors)
    # a null is nobody's neighbour
    assert found[0] == found[1] and set(found[0]) == {1, 2, 3} and len(set(found[0].values())) == 3
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert not glob.glob(f"{root}/stored-*")
