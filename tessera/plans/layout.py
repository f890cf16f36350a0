"""Input layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Data that fills a scan partition: Spark's default for its size.
FULL_PARTITION = 128 << 20


def spread(df: DataFrame) -> DataFrame:
    """Spread rows over the cluster when the input has too few partitions.

    A scan of a few large files can yield fewer partitions than there are
    cores, leaving CPU-heavy per-row work (regex tokenising of long texts)
    to a handful of tasks.  Then rows are dealt round-robin (Spark sorts
    before dealing, so a retried task gets the same rows) into
    ``defaultParallelism`` partitions.  Round-robin rather than by key: the
    following per-key aggregate then keeps its own exchange, which Spark
    reuses when the same aggregate feeds several branches of one query --
    exactly the plan shape of a wide input, where this function is a no-op.

    An input is narrow if it has fewer files than there are cores and less
    data than would fill a scan partition per core.  Both come from the file
    listing and the optimizer's statistics: no job runs, and an input of
    unknown size is left alone.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    target = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= target * FULL_PARTITION or len(df.inputFiles()) >= target:
        return df
    return df.repartition(target)


#: Optimizer's bytes of compressed texts for one task; their terms take many times that.
TEXT_PART = 4 << 20


def text_parts(df: DataFrame) -> int:
    """Into how many parts texts are dealt by key, one number for all uses of
    a table, so that what is counted of it can be joined where it lies."""
    spark = df.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # of a table that is no file or a join Spark only knows that it may be huge
    return least if size > 1 << 50 else max(least, -(-size // TEXT_PART))
