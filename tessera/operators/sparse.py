"""Sparse vectors as relational data.

A vector is long form ``(*by, feature, value)``: absent features are 0.0.
``by`` names the vector key (e.g. ``row_id``) so that many vectors are
handled by one job; with ``by=()`` the frame holds a single vector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _vec(df: DataFrame, by, feature: str, value: str, alias: str) -> DataFrame:
    return df.select(*by, F.col(feature).alias("feature"), F.col(value).cast("double").alias(alias))


def sparse_get(vectors: DataFrame, keys: DataFrame, by: tuple[str, ...] = (),
               feature: str = "feature", value: str = "value") -> DataFrame:
    """Look up ``(*by, feature)`` keys; missing entries give 0.0."""
    v = _vec(vectors, by, feature, value, "_v")
    k = keys.select(*by, F.col(feature).alias("feature"))
    return (k.join(v, [*by, "feature"], "left")
            .select(*by, "feature", F.coalesce(F.col("_v"), F.lit(0.0)).alias("value")))


def sparse_dot(a: DataFrame, b: DataFrame, by: tuple[str, ...] = (),
               feature: str = "feature", value: str = "value") -> DataFrame:
    """Inner product over shared features, one row per vector key of ``a``
    (0.0 when nothing is shared)."""
    va = _vec(a, by, feature, value, "_a")
    vb = _vec(b, by, feature, value, "_b")
    dots = va.join(vb, [*by, "feature"]).groupBy(*by).agg(F.sum(F.col("_a") * F.col("_b")).alias("_d"))
    if not by:
        return dots.select(F.coalesce(F.col("_d"), F.lit(0.0)).alias("dot"))
    keys = va.select(*by).distinct()
    return keys.join(dots, list(by), "left").select(*by, F.coalesce(F.col("_d"), F.lit(0.0)).alias("dot"))


def _combine(a, b, by, feature, value, sign: float) -> DataFrame:
    va = _vec(a, by, feature, value, "value")
    vb = _vec(b, by, feature, value, "value").withColumn("value", F.col("value") * F.lit(sign))
    # partial aggregation before the shuffle; explicit zeros are kept
    return va.unionByName(vb).groupBy(*by, "feature").agg(F.sum("value").alias("value"))


def sparse_add(a: DataFrame, b: DataFrame, by: tuple[str, ...] = (),
               feature: str = "feature", value: str = "value") -> DataFrame:
    """``a + b`` over the union of keys."""
    return _combine(a, b, by, feature, value, 1.0)


def sparse_sub(a: DataFrame, b: DataFrame, by: tuple[str, ...] = (),
               feature: str = "feature", value: str = "value") -> DataFrame:
    """``a - b`` over the union of keys."""
    return _combine(a, b, by, feature, value, -1.0)


def sparse_scale(a: DataFrame, s: float, by: tuple[str, ...] = (),
                 feature: str = "feature", value: str = "value") -> DataFrame:
    """``s * a``; every key is kept."""
    return a.select(*by, F.col(feature).alias("feature"),
                    (F.col(value).cast("double") * F.lit(float(s))).alias("value"))
