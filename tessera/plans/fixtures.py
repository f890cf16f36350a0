"""Views over the driver's tables that stand in for the reference's inputs.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole table; column pruning and filters reach the parquet scan.  The DuckDB
twins of these views live in ``oracle_sql.py`` as SQL fragments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def corpus(spark, sf_dir) -> DataFrame:
    """``(doc_id, text)``: one row per document."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def benchmark_texts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")


def consecutive_pairs(spark, sf_dir) -> DataFrame:
    """``(doc_a, doc_b)`` for every document whose successor id exists."""
    ids = corpus(spark, sf_dir).select("doc_id")
    return (ids.select(F.col("doc_id").alias("doc_a"))
            .join(ids.select(F.col("doc_id").alias("doc_b")),
                  F.col("doc_b") == F.col("doc_a") + 1))


def hub_pairs(spark, sf_dir) -> DataFrame:
    """``(doc_a, doc_b)``: the first document with every other, and every other
    with the two ids that follow, which need not exist."""
    ids = corpus(spark, sf_dir).select("doc_id")
    first = ids.agg(F.min("doc_id")).scalar()
    others = ids.where(F.col("doc_id") != first)
    return (others.select(first.alias("doc_a"), F.col("doc_id").alias("doc_b"))
            .unionAll(others.select(F.col("doc_id").alias("doc_a"), F.explode(F.array(F.col("doc_id") + 1, F.col("doc_id") + 2)).alias("doc_b"))))


def links_out(spark, sf_dir) -> DataFrame:
    """Directed edges supplier -> part, duplicates kept."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"))


def links_in(spark, sf_dir) -> DataFrame:
    """Directed edges part -> supplier, duplicates kept."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def stars(spark, sf_dir) -> DataFrame:
    """Edges customer -> nation (negative ids): one star per nation."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("src"), (-1 - F.col("c_nationkey")).alias("dst"))


def debtor_stars(spark, sf_dir) -> DataFrame:
    """The edges of ``stars`` of customers with a negative balance: most
    customers have no edge."""
    return table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("src"), (-1 - F.col("c_nationkey")).alias("dst"))


def star_nodes(spark, sf_dir) -> DataFrame:
    """``id`` of all customers and nations."""
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")).unionAll(
        table(spark, sf_dir, "nation").select((-1 - F.col("n_nationkey")).cast("long").alias("id")))


def relabelled(edges: DataFrame) -> DataFrame:
    """Isomorphic copy with ids ``id * 7919 + 13``."""
    return edges.select((F.col("src") * 7919 + 13).alias("src"),
                        (F.col("dst") * 7919 + 13).alias("dst"))


def dense(spark, sf_dir) -> DataFrame:
    """``(x1, x2, y, is_test)``: scaled lineitem measures; line 7 is the test split."""
    return table(spark, sf_dir, "lineitem").select(*_measures())


def _measures() -> list:
    return [(F.col("l_quantity") / 50.0).alias("x1"),
            (F.col("l_discount") * 10.0 + 0.0).alias("x2"),
            (F.col("l_extendedprice") / 1e4).alias("y"),
            (F.col("l_linenumber") == 7).alias("is_test")]


def dense_train(spark, sf_dir) -> DataFrame:
    return dense(spark, sf_dir).where(~F.col("is_test")).drop("is_test")


def dense_test(spark, sf_dir) -> DataFrame:
    return dense(spark, sf_dir).where(F.col("is_test")).drop("is_test")


PART_GROUPS = 110


def group_columns() -> list[str]:
    return [f"c{g}" for g in range(PART_GROUPS)]


def dense_wide(spark, sf_dir) -> DataFrame:
    """``(x1, x2, c0 .., y, is_test)``: the measures of ``dense`` and one
    indicator for each group of part keys."""
    li = table(spark, sf_dir, "lineitem")
    g = F.pmod(F.col("l_partkey"), F.lit(PART_GROUPS))
    return li.select(*_measures(), *[(g == k).cast("double").alias(c) for k, c in enumerate(group_columns())])


def sparse_rows(spark, sf_dir) -> DataFrame:
    """``(row_id, label)`` for labelled documents; label +1 if quality is 1."""
    labels = table(spark, sf_dir, "labels")
    docs = corpus(spark, sf_dir).select("doc_id")
    return (labels.join(docs, "doc_id")
            .select(F.col("doc_id").alias("row_id"),
                    F.when(F.col("quality") == 1, 1).otherwise(-1).cast("int").alias("label")))


def sparse(spark, sf_dir) -> DataFrame:
    """Long-form sparse examples ``(row_id, label, feature, value)``.

    value = occurrences of the term / all term occurrences of the document.

    The words of labelled documents meet their labels as one row per document
    and are counted there; the labels, one row per document and quality, are
    broadcast where their exact count (from Parquet footers) is bounded.  A
    label that comes twice counts its document's terms twice.
    """
    from ..operators.text import counted_terms, term_lists
    from .joins import broadcast_if_bounded
    from .layout import text_parts

    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    n = labels.count()
    one = labels.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("_times"))
    every = labels.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_labels"))
    docs = corpus(spark, sf_dir)
    parts = text_parts(docs)
    few = broadcast_if_bounded(every, n)
    if few is not every:
        lists = term_lists(docs.join(few.select("doc_id"), "doc_id", "left_semi"), parts=parts)
    else:
        lists = term_lists(docs, parts=parts)
    lists = lists.join(few, "doc_id").join(broadcast_if_bounded(one, n, row_bytes=24), "doc_id")
    tf = counted_terms(lists, ("doc_id", "quality", "_times", "_labels"))
    return tf.select(F.col("doc_id").alias("row_id"),
                     F.when(F.col("quality") == 1, 1).otherwise(-1).cast("int").alias("label"),
                     F.col("term").alias("feature"),
                     ((F.col("tf") * F.col("_times")) / (F.col("n_terms") * F.col("_labels"))).alias("value"))


def ratings(spark, sf_dir) -> DataFrame:
    """``(user_id, item_id, rating)``: mean quantity/10 per supplier and part."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.col("l_suppkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg((F.avg("l_quantity") / 10.0).alias("rating")))


def rating_folds(spark, sf_dir, k: int = 5) -> DataFrame:
    """Ratings with ``fold = (31 * user_id + item_id) % k``."""
    from ..operators.factor import assign_folds

    return assign_folds(ratings(spark, sf_dir), k)
