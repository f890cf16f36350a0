"""SQL fragments (DuckDB dialect) shared by the oracle queries."""

from __future__ import annotations

# The same whitespace class and letter class as
# tessera.functions.text, spelled for RE2.
WS = r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}]+"


def terms_sql(source: str, keys: str = "doc_id", text: str = "text") -> str:
    """One row per non-empty term occurrence of ``source``: ``(keys, term)``."""
    return f"""SELECT {keys}, term FROM (
      SELECT {keys}, regexp_replace(lower(w), '[^\\p{{L}}]', '', 'g') AS term
      FROM (SELECT {keys}, unnest(string_split_regex({text}, '{WS}')) AS w FROM {source}))
    WHERE term <> ''"""


def r6(expr: str, digits: int = 6) -> str:
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0::DOUBLE)"


# Views of tessera.plans.fixtures, as CTE bodies.
CORPUS = "SELECT doc_id, text FROM documents"
LINKS_OUT = "SELECT l_suppkey AS src, l_partkey AS dst FROM lineitem"
LINKS_IN = "SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem"
STARS = "SELECT c_custkey AS src, -1 - c_nationkey AS dst FROM customer"
DEBTORS = "SELECT c_custkey AS src, -1 - c_nationkey AS dst FROM customer WHERE c_acctbal < 0"
STAR_NODES = "SELECT c_custkey AS id FROM customer UNION SELECT -1 - n_nationkey FROM nation"
HUB_PAIRS = """SELECT (SELECT min(doc_id) FROM documents) AS doc_a, doc_id AS doc_b FROM documents
  WHERE doc_id <> (SELECT min(doc_id) FROM documents)
  UNION ALL SELECT doc_id, doc_id + k FROM documents, (VALUES (1), (2)) steps(k)
  WHERE doc_id <> (SELECT min(doc_id) FROM documents)"""
DENSE = """SELECT l_quantity / 50.0 AS x1, l_discount * 10.0 + 0.0 AS x2,
       l_extendedprice / 1e4 AS y, l_linenumber = 7 AS is_test FROM lineitem"""
# 110: fixtures.PART_GROUPS
DENSE_WIDE = """SELECT l_quantity / 50.0 AS x1, l_discount * 10.0 + 0.0 AS x2,
       l_extendedprice / 1e4 AS y, l_linenumber = 7 AS is_test, l_partkey % 110 AS g FROM lineitem"""
RATINGS = """SELECT l_suppkey AS user_id, l_partkey AS item_id,
       avg(l_quantity) / 10.0 AS rating FROM lineitem GROUP BY l_suppkey, l_partkey"""


def sparse_cte() -> str:
    """CTE list defining ``sparse_rows`` and ``sparse`` (see fixtures.sparse)."""
    return f"""
    lab AS (SELECT l.doc_id, l.quality, d.text FROM labels l JOIN documents d USING (doc_id)),
    sparse_rows AS (SELECT doc_id AS row_id,
                           CAST(CASE WHEN quality = 1 THEN 1 ELSE -1 END AS INTEGER) AS label FROM lab),
    lab_terms AS ({terms_sql('lab', 'doc_id, quality')}),
    lab_tf AS (SELECT doc_id, quality, term, count(*) AS tf FROM lab_terms GROUP BY doc_id, quality, term),
    lab_total AS (SELECT doc_id, sum(tf) AS total FROM lab_tf GROUP BY doc_id),
    sparse AS (SELECT t.doc_id AS row_id,
                      CAST(CASE WHEN quality = 1 THEN 1 ELSE -1 END AS INTEGER) AS label,
                      term AS feature, tf::DOUBLE / total AS value
               FROM lab_tf t JOIN lab_total USING (doc_id))"""
