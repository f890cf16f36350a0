"""Helpers shared by the operators: written intermediate tables, Arrow columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans.iterate import delete_path
from ..session import ensure_checkpoint_dir

#: Keys that hold more than one in so many of a table's rows are joined by broadcast.
HOT_PART = 200


def share_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver found it; a cluster installs it (or gets it with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage and survives lost executors.  ``codec`` is its
    compression, by default the session's."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def discard(table: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing will read again."""
    path = getattr(table, "written_path", None)
    if path:
        delete_path(table.sparkSession, path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column is called so (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def spread_join(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join of a written table with one that has a row per key.  Keys
    with over one in ``HOT_PART`` of the rows, which are about ``HOT_PART`` at
    most, are joined where their rows are."""
    most = rows.count() // HOT_PART
    hot = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(1, most)).select(key), "hot")
    known = table.join(F.broadcast(hot), key, "left_semi")
    even = rows.join(F.broadcast(hot), key, "left_anti").join(table, key)
    return even.unionByName(rows.join(F.broadcast(known), key))


def text_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary column; a null is empty.

    The bytes are a view of the Arrow buffer, so no text is copied.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def read_blob(blob: bytes, kind) -> np.ndarray:
    """A packed column of numbers."""
    return np.frombuffer(blob, kind)


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """Lift a function of one batch to the iterator form of ``mapInArrow``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out
    return run
