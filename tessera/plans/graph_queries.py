"""Registered graph queries (G1-G13) over lineitem supplier/part edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import COLOR_PARTS
from ..operators import graph as G
from . import fixtures as fx
from .oracle_sql import DEBTORS, LINKS_IN, LINKS_OUT, STAR_NODES, STARS, r6 as s6
from .registry import r6, register

GAMMA = 0.15
PR_ITERS = 5
# Rounds of the query that is named by them.  All other WL queries refine until
# the number of colours is unchanged; their SQL twins unroll more rounds than
# the tables need and apply the same stop rule.
WL_ROUNDS = 6
WL_SQL_ROUNDS = 10


def _w_sql(edges: str, more: str = "") -> str:
    """``more``: a query of nodes that need no edge."""
    also = f" UNION ({more})" if more else ""
    return f"""e AS ({edges}),
w AS (SELECT src, dst, cnt::DOUBLE / sum(cnt) OVER (PARTITION BY src) AS w
      FROM (SELECT src, dst, count(*) AS cnt FROM e GROUP BY src, dst)),
nodes AS (SELECT src AS id FROM e UNION SELECT dst FROM e{also}),
n AS (SELECT count(*)::DOUBLE AS n FROM nodes)"""


def _pagerank_sql(edges: str, k: int, more: str = "") -> str:
    parts = [_w_sql(edges, more),
             "s0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT n FROM n) AS score FROM nodes)"]
    for i in range(1, k + 1):
        parts.append(
            f"s{i} AS MATERIALIZED (SELECT w.dst AS id, "
            f"{1.0 - GAMMA!r} * sum(p.score * w.w) + {GAMMA!r} / (SELECT n FROM n) AS score "
            f"FROM w JOIN s{i - 1} p ON p.id = w.src GROUP BY w.dst)")
    return "WITH " + ",\n".join(parts)


def _final_sql(k: int) -> str:
    return (f"SELECT nodes.id, {s6(f'coalesce(s{k}.score, {GAMMA!r} / (SELECT n FROM n))', 9)} AS score "
            f"FROM nodes LEFT JOIN s{k} USING (id)")


@register("transition_weights", f"WITH {_w_sql(LINKS_OUT)} SELECT src, dst, {s6('w', 9)} AS w FROM w")
def transition_weights(spark, sf_dir):
    w = G.out_links(fx.links_out(spark, sf_dir))
    return w.select("src", "dst", r6("w", 9).alias("w"))


@register("graph_nodes", f"WITH {_w_sql(LINKS_OUT)} SELECT id FROM nodes")
def graph_nodes(spark, sf_dir):
    return G.graph_nodes(fx.links_out(spark, sf_dir))


@register("node_count", f"WITH {_w_sql(LINKS_OUT)} SELECT count(*) AS n_nodes FROM nodes")
def node_count(spark, sf_dir):
    return G.node_count(fx.links_out(spark, sf_dir))


@register("degree", f"""WITH e AS ({LINKS_OUT})
SELECT id, count(*) AS degree FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id""")
def degree(spark, sf_dir):
    return G.degree(fx.links_out(spark, sf_dir))


def _pagerank(spark, sf_dir, edges_fn=fx.links_out):
    return G.pagerank(edges_fn(spark, sf_dir), gamma=GAMMA, max_iter=PR_ITERS, eps=0.0)


@register("pagerank_k5", _pagerank_sql(LINKS_OUT, PR_ITERS) + "\n" + _final_sql(PR_ITERS))
def pagerank_k5(spark, sf_dir):
    res = _pagerank(spark, sf_dir)
    return res.scores.select("id", r6("score", 9).alias("score"))


@register("pagerank_links_in_k5", _pagerank_sql(LINKS_IN, PR_ITERS) + "\n" + _final_sql(PR_ITERS))
def pagerank_links_in_k5(spark, sf_dir):
    res = _pagerank(spark, sf_dir, fx.links_in)
    return res.scores.select("id", r6("score", 9).alias("score"))


@register("pagerank_delta", _pagerank_sql(LINKS_OUT, PR_ITERS) + "\n" + "\nUNION ALL\n".join(
    f"SELECT {i}::INTEGER AS iteration, {s6(f'coalesce(sum(abs(a.score - b.score)), 0.0)', 9)} AS err "
    f"FROM s{i - 1} a JOIN s{i} b USING (id)" for i in range(1, PR_ITERS + 1)))
def pagerank_delta(spark, sf_dir):
    res = _pagerank(spark, sf_dir)
    return res.history_df(spark).select("iteration", r6("err", 9).alias("err"))


@register("pagerank_split_k5", _pagerank_sql(LINKS_OUT, PR_ITERS) + "\n" + _final_sql(PR_ITERS))
def pagerank_split_k5(spark, sf_dir):
    """The plan for scores that are too many to broadcast, at any size."""
    res = G.pagerank(fx.links_out(spark, sf_dir), gamma=GAMMA, max_iter=PR_ITERS, eps=0.0, broadcast_rows=0)
    return res.scores.select("id", r6("score", 9).alias("score"))


def _standard_sql(edges: str, k: int) -> str:
    parts = [_w_sql(edges),
             "s0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE / (SELECT n FROM n) AS score FROM nodes)"]
    for i in range(1, k + 1):
        lost = f"(SELECT coalesce(sum(score), 0.0) FROM s{i - 1} WHERE id NOT IN (SELECT src FROM e))"
        parts.append(
            f"s{i} AS MATERIALIZED (SELECT id, {1.0 - GAMMA!r} * (coalesce(r.got, 0.0) + {lost} / (SELECT n FROM n)) "
            f"+ {GAMMA!r} / (SELECT n FROM n) AS score FROM nodes LEFT JOIN "
            f"(SELECT w.dst AS id, sum(p.score * w.w) AS got FROM w JOIN s{i - 1} p ON p.id = w.src GROUP BY w.dst) r "
            f"USING (id))")
    return "WITH " + ",\n".join(parts) + f"\nSELECT id, {s6(f's{k}.score', 9)} AS score FROM s{k}"


@register("pagerank_standard_k5", _standard_sql(LINKS_OUT, PR_ITERS))
def pagerank_standard_k5(spark, sf_dir):
    """Textbook PageRank: scores sum to 1."""
    res = G.pagerank(fx.links_out(spark, sf_dir), gamma=GAMMA, max_iter=PR_ITERS, eps=0.0, mode="standard")
    return res.scores.select("id", r6("score", 9).alias("score"))


@register("sourceless_nodes", f"""WITH {_w_sql(LINKS_IN)}
SELECT id, {s6(f'{GAMMA!r} / (SELECT n FROM n)', 9)} AS score
FROM nodes WHERE id NOT IN (SELECT dst FROM e)""")
def sourceless_nodes(spark, sf_dir):
    """Nodes that no step can reach (no in-edge), filled with gamma / n."""
    edges = fx.links_in(spark, sf_dir)
    nodes = G.graph_nodes(edges)
    n = G.node_count(edges).scalar()
    targets = edges.select(F.col("dst").alias("id"))
    return (nodes.join(targets, "id", "left_anti")
            .select("id", r6(F.lit(GAMMA) / n, 9).alias("score")))


@register("pagerank_top", _pagerank_sql(LINKS_OUT, PR_ITERS)
          + f"\nSELECT * FROM ({_final_sql(PR_ITERS)}) ORDER BY score DESC, id LIMIT 20")
def pagerank_top(spark, sf_dir):
    res = _pagerank(spark, sf_dir)
    scores = res.scores.select("id", r6("score", 9).alias("score"))
    return scores.orderBy(F.desc("score"), F.asc("id")).limit(20)


@register("pagerank_ranked", _pagerank_sql(LINKS_OUT, PR_ITERS)
          + f"\nSELECT * FROM ({_final_sql(PR_ITERS)}) ORDER BY score DESC, id")
def pagerank_ranked(spark, sf_dir):
    """The whole ranking, best first (a range-partitioned sort)."""
    return pagerank_k5(spark, sf_dir).orderBy(F.desc("score"), F.asc("id"))


# --------------------------------------------------------------------------
# Weisfeiler-Lehman

def _wl_sql(graph_edges: str, k: int, more: str = "") -> str:
    """CTEs ``ge`` (g, src, dst) -> ... -> ``final`` (g, id, color)."""
    sums = " || ':' || ".join(f"CAST(sum(('0x' || substr(md5(c.color), {1 + 6 * p}, 6))::BIGINT) AS VARCHAR)"
                              for p in range(COLOR_PARTS))
    parts = [f"ge AS ({graph_edges})",
             "adj AS (SELECT g, src AS node, dst AS nbr FROM ge UNION ALL SELECT g, dst, src FROM ge)",
             f"alone AS (SELECT g, id FROM ({more}) WHERE (g, id) NOT IN (SELECT g, node FROM adj))" if more else
             "alone AS (SELECT g, node AS id FROM adj WHERE false)",
             "c0 AS MATERIALIZED (SELECT DISTINCT g, node AS id, '1' AS color FROM adj UNION ALL SELECT g, id, '1' FROM alone)"]
    empty = ":".join("0" * COLOR_PARTS)
    for i in range(1, k + 1):
        parts.append(
            f"c{i} AS MATERIALIZED (SELECT a.g, a.node AS id, "
            f"md5({sums}) AS color "
            f"FROM adj a JOIN c{i - 1} c ON c.g = a.g AND c.id = a.nbr GROUP BY a.g, a.node "
            f"UNION ALL SELECT g, id, md5('{empty}') FROM alone)")
    counts = ", ".join(f"(SELECT count(DISTINCT color) FROM c{i}) AS n{i}" for i in range(k + 1))
    cases = " ".join(f"WHEN n{i} = n{i - 1} THEN {i}" for i in range(1, k + 1))
    parts.append(f"stop AS (SELECT CASE {cases} ELSE {k} END AS r FROM (SELECT {counts}))")
    parts.append("final AS (" + " UNION ALL ".join(
        f"SELECT g, id, color FROM c{i} WHERE (SELECT r FROM stop) = {i}" for i in range(1, k + 1)) + ")")
    return ",\n".join(parts)


_ONE = f"SELECT 1 AS g, src, dst FROM ({LINKS_OUT})"
_TWO = (f"SELECT 1 AS g, src, dst FROM ({LINKS_OUT}) UNION ALL "
        f"SELECT 2 AS g, src * 7919 + 13, dst * 7919 + 13 FROM ({LINKS_OUT})")


# Customers and their nations: a star per nation, so customers of a nation share a colour.
_STARS = f"""SELECT 1 AS g, src, dst FROM ({STARS}) UNION ALL
SELECT 2 AS g, src * 7919 + 13, dst * 7919 + 13 FROM ({STARS})"""


def _star_joint(spark, sf_dir):
    edges = fx.stars(spark, sf_dir)
    return G.joint_colors(edges, fx.relabelled(edges))


def _joint(spark, sf_dir):
    edges = fx.links_out(spark, sf_dir)
    return G.joint_colors(edges, fx.relabelled(edges))


@register(f"wl_colors_k{WL_ROUNDS}", f"WITH {_wl_sql(_ONE, WL_ROUNDS)} SELECT id, color FROM final")
def wl_colors(spark, sf_dir):
    return G.wl_colors(fx.links_out(spark, sf_dir), WL_ROUNDS)


@register("wl_colors", f"WITH {_wl_sql(_ONE, WL_SQL_ROUNDS)} SELECT id, color FROM final")
def wl_colors_final(spark, sf_dir):
    return G.wl_colors(fx.links_out(spark, sf_dir))


@register("wl_colors_split", f"WITH {_wl_sql(_ONE, WL_SQL_ROUNDS)} SELECT id, color FROM final")
def wl_colors_split(spark, sf_dir):
    """The plan for colours that are too many to broadcast, at any size."""
    return G.wl_colors(fx.links_out(spark, sf_dir), broadcast_rows=0)


@register("color_distribution", f"""WITH {_wl_sql(_ONE, WL_SQL_ROUNDS)}
SELECT class_size, count(*) AS n_classes FROM (SELECT color, count(*) AS class_size FROM final GROUP BY color)
GROUP BY class_size""")
def color_distribution(spark, sf_dir):
    return G.color_distribution(G.wl_colors(fx.links_out(spark, sf_dir)))


def _verdict_sql(pair: str, more: str = "") -> str:
    return f"""WITH {_wl_sql(pair, WL_SQL_ROUNDS, more)},
sizes AS (SELECT g, color, count(*) AS s FROM final GROUP BY g, color),
mism AS (SELECT count(*) AS m FROM (SELECT color, s FROM sizes WHERE g = 1) a
         FULL OUTER JOIN (SELECT color, s FROM sizes WHERE g = 2) b USING (color)
         WHERE a.s IS NULL OR b.s IS NULL OR a.s <> b.s),
summ AS (SELECT count_if(g = 1) AS n_nodes_1, count_if(g = 2) AS n_nodes_2,
                count(DISTINCT CASE WHEN g = 1 THEN color END) AS n_colors_1,
                count(DISTINCT CASE WHEN g = 2 THEN color END) AS n_colors_2 FROM final)
SELECT CASE WHEN n_nodes_1 <> n_nodes_2 THEN 'not isomorphic'
            WHEN (SELECT m FROM mism) > 0 THEN 'not isomorphic'
            WHEN n_colors_1 = n_nodes_1 THEN 'isomorphic' ELSE 'maybe isomorphic' END AS verdict,
       n_nodes_1, n_nodes_2, n_colors_1, n_colors_2 FROM summ"""


@register("graph_verdict", _verdict_sql(_TWO))
def graph_verdict(spark, sf_dir):
    return G.compare_colorings(_joint(spark, sf_dir))


@register("node_mapping", f"""WITH {_wl_sql(_TWO, WL_SQL_ROUNDS)},
single AS (SELECT color FROM final GROUP BY color HAVING count_if(g = 1) = 1 AND count_if(g = 2) = 1)
SELECT a.id AS node_1, b.id AS node_2 FROM final a JOIN single USING (color)
JOIN final b ON b.color = a.color AND b.g = 2 WHERE a.g = 1""")
def node_mapping(spark, sf_dir):
    return G.node_mapping(_joint(spark, sf_dir))


def _candidates_sql(pair: str) -> str:
    return f"""WITH {_wl_sql(pair, WL_SQL_ROUNDS)},
sizes AS (SELECT color, count_if(g = 1) AS size_1, count_if(g = 2) AS size_2 FROM final GROUP BY color
          HAVING count_if(g = 1) > 0 AND count_if(g = 2) > 0)
SELECT color, g, id, size_1, size_2 FROM final JOIN sizes USING (color)"""


@register("candidate_mapping", _candidates_sql(_TWO))
def candidate_mapping(spark, sf_dir):
    return G.candidate_mapping(_joint(spark, sf_dir))


@register("star_verdict", _verdict_sql(_STARS))
def star_verdict(spark, sf_dir):
    return G.compare_colorings(_star_joint(spark, sf_dir))


@register("star_candidates", _candidates_sql(_STARS))
def star_candidates(spark, sf_dir):
    return G.candidate_mapping(_star_joint(spark, sf_dir))


@register("star_color_distribution", f"""WITH {_wl_sql(f"SELECT 1 AS g, src, dst FROM ({STARS})", WL_SQL_ROUNDS)}
SELECT class_size, count(*) AS n_classes FROM (SELECT color, count(*) AS class_size FROM final GROUP BY color)
GROUP BY class_size""")
def star_color_distribution(spark, sf_dir):
    return G.color_distribution(G.wl_colors(fx.stars(spark, sf_dir)))


# --------------------------------------------------------------------------
# graphs with nodes that have no edge

_ALL_ONE = f"SELECT 1 AS g, id FROM ({STAR_NODES})"
_ALL_TWO = f"{_ALL_ONE} UNION ALL SELECT 2 AS g, id * 7919 + 13 FROM ({STAR_NODES})"
_DEBTORS_TWO = f"""SELECT 1 AS g, src, dst FROM ({DEBTORS}) UNION ALL
SELECT 2 AS g, src * 7919 + 13, dst * 7919 + 13 FROM ({DEBTORS})"""


@register("debtor_degree", f"""WITH e AS ({DEBTORS}), ends AS (SELECT src AS id FROM e UNION ALL SELECT dst FROM e)
SELECT id, count(ends.id) AS degree FROM ({STAR_NODES}) n LEFT JOIN ends USING (id) GROUP BY id""")
def debtor_degree(spark, sf_dir):
    """Degrees, 0 for customers and nations without an edge."""
    return G.degree(fx.debtor_stars(spark, sf_dir), fx.star_nodes(spark, sf_dir))


@register("debtor_pagerank_k5", _pagerank_sql(DEBTORS, PR_ITERS, STAR_NODES) + "\n" + _final_sql(PR_ITERS))
def debtor_pagerank(spark, sf_dir):
    """Ranks of all nodes where most have no edge."""
    res = G.pagerank(fx.debtor_stars(spark, sf_dir), gamma=GAMMA, max_iter=PR_ITERS, eps=0.0, nodes=fx.star_nodes(spark, sf_dir))
    return res.scores.select("id", r6("score", 9).alias("score"))


@register("debtor_colors", f"WITH {_wl_sql(f'SELECT 1 AS g, src, dst FROM ({DEBTORS})', WL_SQL_ROUNDS, _ALL_ONE)} SELECT id, color FROM final")
def debtor_colors(spark, sf_dir):
    return G.wl_colors(fx.debtor_stars(spark, sf_dir), nodes=fx.star_nodes(spark, sf_dir))


@register("debtor_verdict", _verdict_sql(_DEBTORS_TWO, _ALL_TWO))
def debtor_verdict(spark, sf_dir):
    edges, nodes = fx.debtor_stars(spark, sf_dir), fx.star_nodes(spark, sf_dir)
    other = nodes.select((F.col("id") * 7919 + 13).alias("id"))
    return G.compare_graphs(edges, fx.relabelled(edges), nodes1=nodes, nodes2=other)
