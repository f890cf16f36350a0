"""Running term counts over a stream of text lines (S1 + T3 on a stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.text import tokenize


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files appearing under ``path`` as a stream of ``value`` lines."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def running_term_frequency(lines: DataFrame, text: str = "value") -> DataFrame:
    """Term counts over everything seen so far (use ``outputMode('complete')``
    or ``'update'``).  Same tokenising and counting as the batch operator;
    the per-term counts live in Spark's state store."""
    from pyspark.sql import functions as F

    return tokenize(lines, text).groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
