"""Connected components of an edge table by repeated hooking and shortcutting.

State is an edge table ``(u, v)`` with ``u > v``.  Each round takes
``parent(u) = min(v)``, hooks every other ``v`` of ``u`` to that parent and
replaces parents by grandparents.  Nothing is gathered per node: the parent is
a partially aggregated minimum and both joins are sort-merge joins of written
tables, whose skewed partitions adaptive execution splits.  Rounds grow with
the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node that is not the smallest of its
    component; ``component`` is the smallest node reachable.  Self loops,
    repeated edges and edges with a null end are ignored; no edges give an
    empty table."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    held = state = written(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
                    .where("u > v").distinct(), "edges")
    while True:
        parent = written(state.groupBy("u").agg(F.min("v").alias("p")), "parents")
        hooked = (state.join(parent, "u").where("v <> p")
                  .select(F.col("v").alias("x"), F.col("p").alias("y"))
                  .select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v"), F.lit(True).alias("moved")))
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        short = (parent.join(up, "p", "left")
                 .select("u", F.coalesce("pp", "p").alias("v"), F.col("pp").isNotNull().alias("moved")))
        after = written(hooked.unionByName(short).groupBy("u", "v").agg(F.max("moved").alias("moved")), "edges")
        discard(held)
        if not after.where("moved").take(1):
            discard(after)
            return parent.select(F.col("u").alias("node"), F.col("p").alias("component"))
        discard(parent)
        held, state = after, after.select("u", "v")
