"""Versioned models: every iteration's model of a training run, kept side by side.

A run's folder has one part per iteration, ``iteration=k``, with the rows
``(feature, value)`` of the model after it.  Versions are only added; a version
that is written again (a restarted run) replaces itself as a whole, so the
folder never holds half of one or two of the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

MODEL_SCHEMA = "feature string, value double, iteration int"


def append_version(model: DataFrame, path: str, iteration: int) -> None:
    """Add ``model`` as the version after ``iteration``."""
    model.select("feature", "value").write.mode("overwrite").parquet(f"{path.rstrip('/')}/iteration={iteration}")


def load_versions(spark: SparkSession, path: str) -> DataFrame:
    """``(iteration, feature, value)`` of all versions."""
    return spark.read.schema(MODEL_SCHEMA).parquet(path).select("iteration", "feature", "value")


def load_version(spark: SparkSession, path: str, iteration: int | None = None) -> DataFrame:
    """``(feature, value)`` after ``iteration``, by default the latest; only its part is read."""
    every = load_versions(spark, path)
    if iteration is None:
        iteration = every.agg(F.max("iteration")).first()[0]
    return every.where(F.col("iteration") == F.lit(iteration)).select("feature", "value")


def coefficient_changes(spark: SparkSession, path: str) -> DataFrame:
    """``(iteration, n_features, moved)``: features in each version and the
    Euclidean distance from the version before (from no model for the first)."""
    every = load_versions(spark, path)
    before = every.select((F.col("iteration") + 1).alias("iteration"), "feature", F.col("value").alias("_old"))
    last = every.agg(F.max("iteration")).scalar()
    met = every.join(before.where(F.col("iteration") <= last), ["iteration", "feature"], "full_outer")
    step = F.coalesce("value", F.lit(0.0)) - F.coalesce("_old", F.lit(0.0))
    return met.groupBy("iteration").agg(F.count("value").alias("n_features"), F.sqrt(F.sum(step * step)).alias("moved"))
