"""Graph operators: transition weights, nodes, degree, PageRank and
Weisfeiler-Lehman colour refinement with graph comparison.

Edges are a DataFrame ``(src, dst)``; duplicate edges are kept and count.  Nodes
without any edge take part where a table ``nodes`` with their ``id`` is given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import md5_parts, multiset_color
from ..plans import joins
from ..plans.iterate import Materializer
from ..plans.joins import broadcast_if_bounded


# --------------------------------------------------------------------------
# single-pass operators

def out_links(edges: DataFrame) -> DataFrame:
    """``(src, dst, w)`` with ``w = multiplicity / out_degree(src)``.

    Both aggregates are partial before the shuffle; the join attaches each
    source's out-degree (one row per source) to its distinct targets.
    """
    pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("_m"))
    outdeg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("_deg"))
    return pairs.join(outdeg, "src").select(
        "src", "dst", (F.col("_m") / F.col("_deg")).alias("w"))


def graph_nodes(edges: DataFrame, by: tuple[str, ...] = (), nodes: DataFrame | None = None) -> DataFrame:
    """Distinct ids on either side of an edge or in ``nodes``: ``(*by, id)``."""
    ends = (edges.select(*by, F.col("src").alias("id"))
            .union(edges.select(*by, F.col("dst").alias("id"))))
    if nodes is not None:
        ends = ends.union(nodes.select(*by, "id"))
    return ends.distinct()


def node_count(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    return graph_nodes(edges, nodes=nodes).agg(F.count(F.lit(1)).alias("n_nodes"))


def degree(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Undirected degree; multi-edges count each time, a self-loop counts 2, a
    node of ``nodes`` without an edge has 0."""
    one = F.lit(1).alias("_e")
    ends = edges.select(F.col("src").alias("id"), one).unionAll(edges.select(F.col("dst").alias("id"), one))
    if nodes is not None:
        ends = ends.unionAll(nodes.select("id", F.lit(0).alias("_e")))
    return ends.groupBy("id").agg(F.sum("_e").alias("degree"))


# --------------------------------------------------------------------------
# PageRank

def pagerank_step(weights, scores: DataFrame, gamma: float, n: int,
                  known_nodes: int | None = None, limit: int | None = None, row_bytes: float = 16) -> DataFrame:
    """One update: ``(1-gamma) * sum(score(src) * w) + gamma / n`` per target.

    Inner join: a node that receives nothing gets no row.  The score table
    (one row per node) is broadcast only when its exact size is bounded;
    beyond that ``weights`` is a ``SkewSplitTable`` of the edges by source.
    """
    s = scores.select(F.col("id").alias("src"), "score")
    if isinstance(weights, joins.SkewSplitTable):
        contrib = weights.join(s)
    else:
        contrib = weights.join(broadcast_if_bounded(s, known_nodes, limit, row_bytes), "src")
    return (contrib.groupBy(F.col("dst").alias("id"))
            .agg((F.lit(1.0 - gamma) * F.sum(F.col("score") * F.col("w"))
                  + F.lit(gamma / n)).alias("score")))


def score_change(old: DataFrame, new: DataFrame) -> DataFrame:
    """L1 distance over nodes present in both: one row ``err`` (0.0 if none)."""
    j = old.select("id", F.col("score").alias("_o")).join(
        new.select("id", F.col("score").alias("_n")), "id")
    return j.agg(F.coalesce(F.sum(F.abs(F.col("_o") - F.col("_n"))), F.lit(0.0)).alias("err"))


def fill_sourceless(nodes: DataFrame, scores: DataFrame, gamma: float, n: int) -> DataFrame:
    """Every node; nodes without a score get ``gamma / n``."""
    return (nodes.join(scores, "id", "left")
            .select("id", F.coalesce(F.col("score"), F.lit(gamma / n)).alias("score")))


#: A score beside its node's id.
SCORE_BYTES = 8


class PageRankResult:
    def __init__(self, scores: DataFrame, history: list[tuple[int, float]], n: int):
        self.scores = scores
        self.history = history
        self.n = n

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, "iteration int, err double")


def standard_step(received: DataFrame, scores: DataFrame, sources: DataFrame, nodes: DataFrame,
                  gamma: float, n: int) -> DataFrame:
    """Textbook step: every node keeps a row (``gamma / n`` plus what it
    ``received`` undamped), and the mass of nodes without out-edges (not in
    ``sources``) is spread uniformly."""
    dangling = (scores.join(sources, "id", "left_anti")
                .agg(F.coalesce(F.sum("score"), F.lit(0.0))).scalar())
    return (nodes.join(received.select("id", F.col("score").alias("_r")), "id", "left")
            .select("id", (F.lit(1.0 - gamma) * (F.coalesce(F.col("_r"), F.lit(0.0)) + dangling / F.lit(float(n)))
                           + F.lit(gamma / n)).alias("score")))


def pagerank(edges: DataFrame, gamma: float = 0.15, max_iter: int = 50,
             eps: float = 0.01, mode: str = "sparse",
             broadcast_rows: int | None = None, nodes: DataFrame | None = None) -> PageRankResult:
    """PageRank.

    ``mode='sparse'`` (default) keeps the reference's semantics: start at
    1/n; each step keeps only nodes that receive a contribution; mass of
    nodes without out-edges is lost; stop after ``max_iter`` steps or when
    the L1 change over common nodes is at most ``eps`` (0 when there are no
    common nodes); nodes without a final score get ``gamma / n``.
    ``mode='standard'`` is the textbook variant (see ``standard_step``).
    Scores of more than ``broadcast_rows`` nodes (default: the library's
    bound, and its bytes as measured) are joined with edges bucketed by source
    instead of broadcast.  ``nodes`` adds ids without edges: they count in n,
    pass nothing on, and end with ``gamma / n`` in the sparse mode.
    """
    spark = edges.sparkSession
    mat = Materializer(spark)
    weights = mat(out_links(edges))
    nodes = mat(graph_nodes(edges, nodes=nodes))
    n, width = joins.measured(nodes)
    width += SCORE_BYTES
    scores = mat(nodes.select("id", F.lit(1.0 / max(1, n)).alias("score")))
    standard = mode == "standard"
    sources = mat(weights.select(F.col("src").alias("id")).distinct()) if standard else None
    target, keep = weights, (weights,)
    if broadcast_if_bounded(scores, n, broadcast_rows, width) is scores:
        # scores too large to broadcast: bucket the edges by source once
        target = joins.SkewSplitTable(weights, ["src"], mat, weights.count(), SCORE_BYTES)
        keep = target.live()
    if standard:
        keep += (sources,)
    history: list[tuple[int, float]] = []
    i, err = 0, eps + 1.0
    try:
        while i < max_iter and err > eps:
            i += 1
            step = pagerank_step(target, scores, 0.0 if standard else gamma, n, n, broadcast_rows, width)
            new = mat(standard_step(step, scores, sources, nodes, gamma, n) if standard else step)
            err = float(score_change(scores, new).first()["err"])
            history.append((i, err))
            mat.release_all_but(nodes, new, *keep)
            scores = new
    finally:
        if target is not weights:
            target.close()
    mat.release_all_but(nodes, scores)
    return PageRankResult(fill_sourceless(nodes, scores, gamma, n), history, n)


# --------------------------------------------------------------------------
# Weisfeiler-Lehman colour refinement

INITIAL_COLOR = "1"
# five parts of 8 bytes beside a graph number and an id
COLOR_BYTES = 40


def _undirected(edges: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """``(*by, node, nbr)``: each edge read both ways (self-loops twice)."""
    return (edges.select(*by, F.col("src").alias("node"), F.col("dst").alias("nbr"))
            .unionAll(edges.select(*by, F.col("dst").alias("node"), F.col("src").alias("nbr"))))


def wl_refine(adjacent, colors: DataFrame, by: tuple[str, ...] = (),
              n_nodes: int | None = None, limit: int | None = None, row_bytes: float = 16 + COLOR_BYTES,
              isolated: DataFrame | None = None) -> DataFrame:
    """One refinement round: colour of v = hash of the multiset of its
    neighbours' colours (own colour not included, multi-edges repeated).

    The multiset hash is a sum, so the aggregate is partial per task and a
    hub node never gathers its neighbour list in one place.  The colour
    table (one row per node) is broadcast when its exact size is bounded;
    the explicit hint also keeps the planner from broadcasting the
    adjacency list on a low size estimate.  Nodes in ``isolated`` have no
    neighbours: theirs is the colour of the empty multiset.
    """
    parts = [p.alias(f"_p{k}") for k, p in enumerate(md5_parts(F.col("color")))]
    c = colors.select(*by, F.col("id").alias("nbr"), *parts)
    if isinstance(adjacent, joins.SkewSplitTable):
        j = adjacent.join(c)
    else:
        j = adjacent.join(broadcast_if_bounded(c, n_nodes, limit, row_bytes), [*by, "nbr"])
    if isolated is not None:
        sums = [f"_p{k}" for k in range(len(parts))]
        none = [F.lit(0).cast("long").alias(c) for c in sums]
        j = j.select(*by, "node", *sums).unionByName(isolated.select(*by, F.col("id").alias("node"), *none))
    return (j.groupBy(*by, F.col("node").alias("id"))
            .agg(multiset_color([F.sum(f"_p{k}") for k in range(len(parts))]).alias("color")))


def _n_colors(colors: DataFrame) -> int:
    return colors.select("color").distinct().count()


def wl_colors(edges: DataFrame, max_rounds: int | None = None,
              by: tuple[str, ...] = (), broadcast_rows: int | None = None,
              nodes: DataFrame | None = None) -> DataFrame:
    """Final colouring ``(*by, id, color)``.

    Starts with one colour for all nodes and refines until the number of
    distinct colours stops changing (or ``max_rounds`` rounds ran); returns
    the newest colouring.  With ``by`` several graphs run together and their
    colours stay comparable.  Colours of more than ``broadcast_rows`` nodes
    (default: the library's bound, and its bytes as measured) are joined with
    an adjacency bucketed by neighbour instead of broadcast.  Edges are stored
    once, as they are, and read both ways.  ``nodes``, with ``by`` and ``id``,
    adds ids without edges.
    """
    spark = edges.sparkSession
    mat = Materializer(spark)
    edges = mat.table(edges.select(*by, "src", "dst"))
    adjacent = _undirected(edges, by)
    colors = mat(graph_nodes(edges, by, nodes).select(*by, "id", F.lit(INITIAL_COLOR).alias("color")))
    n_nodes, width = joins.measured(colors.drop("color"))
    width += COLOR_BYTES
    isolated = None
    if nodes is not None:
        isolated = mat(colors.join(adjacent.select(*by, F.col("node").alias("id")), [*by, "id"], "left_anti").select(*by, "id"))
    target, keep = adjacent, (edges,)
    if broadcast_if_bounded(colors, n_nodes, broadcast_rows, width) is colors:
        # colours too large to broadcast: bucket the adjacency by neighbour once
        target = joins.SkewSplitTable(adjacent, [*by, "nbr"], mat, adjacent.count(), COLOR_BYTES)
        keep = target.live()
    if isolated is not None:
        keep += (isolated,)
    count = _n_colors(colors)
    rounds = 0
    try:
        while True:
            rounds += 1
            new = mat(wl_refine(target, colors, by, n_nodes, broadcast_rows, width, isolated))
            new_count = _n_colors(new)
            mat.release_all_but(*keep, new)
            if new_count == count or (max_rounds is not None and rounds >= max_rounds):
                mat.release_all_but(new)
                return new
            colors, count = new, new_count
    finally:
        if target is not adjacent:
            target.close()


def color_distribution(colors: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Class sizes as a histogram ``(*by, class_size, n_classes)``
    (the sorted list of class sizes, colours dropped)."""
    sizes = colors.groupBy(*by, "color").agg(F.count(F.lit(1)).alias("class_size"))
    return sizes.groupBy(*by, "class_size").agg(F.count(F.lit(1)).alias("n_classes"))


def joint_colors(g1: DataFrame, g2: DataFrame, max_rounds: int | None = None,
                 nodes1: DataFrame | None = None, nodes2: DataFrame | None = None) -> DataFrame:
    """Colours of both graphs computed together: ``(g, id, color)``, g in {1, 2}."""
    joint = (g1.select(F.lit(1).alias("g"), "src", "dst")
             .unionAll(g2.select(F.lit(2).alias("g"), "src", "dst")))
    nodes = None
    for g, more in ((1, nodes1), (2, nodes2)):
        if more is not None:
            more = more.select(F.lit(g).alias("g"), "id")
            nodes = more if nodes is None else nodes.unionAll(more)
    return wl_colors(joint, max_rounds, by=("g",), nodes=nodes)


def compare_colorings(colors: DataFrame) -> DataFrame:
    """Verdict from a joint colouring ``(g, id, color)``.

    "not isomorphic" if node counts differ or the (colour, class size)
    tables differ; "isomorphic" if they agree and every class is a single
    node; "maybe isomorphic" otherwise.
    """
    sizes = colors.groupBy("g", "color").agg(F.count(F.lit(1)).alias("_size"))
    s1 = sizes.where(F.col("g") == 1).select("color", F.col("_size").alias("_s1"))
    s2 = sizes.where(F.col("g") == 2).select("color", F.col("_size").alias("_s2"))
    mismatches = (s1.join(s2, "color", "full_outer")
                  .where(F.col("_s1").isNull() | F.col("_s2").isNull()
                         | (F.col("_s1") != F.col("_s2")))
                  .agg(F.count(F.lit(1))).scalar())
    summary = colors.agg(
        F.count_if(F.col("g") == 1).alias("n_nodes_1"),
        F.count_if(F.col("g") == 2).alias("n_nodes_2"),
        F.count_distinct(F.when(F.col("g") == 1, F.col("color"))).alias("n_colors_1"),
        F.count_distinct(F.when(F.col("g") == 2, F.col("color"))).alias("n_colors_2"))
    verdict = (F.when(F.col("n_nodes_1") != F.col("n_nodes_2"), "not isomorphic")
               .when(mismatches > 0, "not isomorphic")
               .when(F.col("n_colors_1") == F.col("n_nodes_1"), "isomorphic")
               .otherwise("maybe isomorphic"))
    return summary.select(verdict.alias("verdict"), "n_nodes_1", "n_nodes_2",
                          "n_colors_1", "n_colors_2")


def compare_graphs(g1: DataFrame, g2: DataFrame, max_rounds: int | None = None,
                   nodes1: DataFrame | None = None, nodes2: DataFrame | None = None) -> DataFrame:
    """Verdict on two graphs; colours are only refined if the graphs have as
    many nodes (without refinement each graph has its one first colour)."""
    every1, every2 = graph_nodes(g1, nodes=nodes1), graph_nodes(g2, nodes=nodes2)
    if every1.count() != every2.count():
        joint = (every1.select(F.lit(1).alias("g"), "id", F.lit(INITIAL_COLOR).alias("color"))
                 .unionAll(every2.select(F.lit(2).alias("g"), "id", F.lit(INITIAL_COLOR).alias("color"))))
        return compare_colorings(joint)
    return compare_colorings(joint_colors(g1, g2, max_rounds, nodes1, nodes2))


def _where_equal(colors: DataFrame) -> DataFrame:
    """The colouring, or none of its rows if the verdict is "not isomorphic"."""
    verdict = compare_colorings(colors).select("verdict").scalar()
    return colors.where(verdict != "not isomorphic")


def node_mapping(colors: DataFrame) -> DataFrame:
    """``(node_1, node_2)`` for every colour held by exactly one node in each
    graph; no rows if the graphs are not isomorphic.  When the colouring is
    discrete this is the full bijection; larger classes are never expanded
    into all pairs."""
    colors = _where_equal(colors)
    single = (colors.groupBy("color")
              .agg(F.count_if(F.col("g") == 1).alias("_c1"), F.count_if(F.col("g") == 2).alias("_c2"))
              .where((F.col("_c1") == 1) & (F.col("_c2") == 1)).select("color"))
    c1 = colors.where(F.col("g") == 1).select("color", F.col("id").alias("node_1"))
    c2 = colors.where(F.col("g") == 2).select("color", F.col("id").alias("node_2"))
    return c1.join(single, "color").join(c2, "color").select("node_1", "node_2")


def candidate_mapping(colors: DataFrame) -> DataFrame:
    """Candidate table in long form ``(color, g, id, size_1, size_2)``: every
    node of both graphs with both class sizes, or no rows if the graphs are
    not isomorphic.  Grouping
    it by colour gives the reference's per-colour node lists without ever
    building an unbounded list."""
    colors = _where_equal(colors)
    sizes = (colors.groupBy("color")
             .agg(F.count_if(F.col("g") == 1).alias("size_1"),
                  F.count_if(F.col("g") == 2).alias("size_2"))
             .where((F.col("size_1") > 0) & (F.col("size_2") > 0)))
    return colors.join(sizes, "color").select("color", "g", "id", "size_1", "size_2")
