"""Files below a path, listed and read by tasks.

Directories are listed level by level: every level is a table of directories
that is dealt over the cluster, so neither the walk nor its result passes
through the driver.  Storage is reached with Arrow's file systems (local,
HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir, share_code

SCHEMA = "path string, is_dir boolean, size long"
#: Directories that one task lists, and the most bytes of files that one task reads, about.
DIRECTORIES_PER_TASK = 64
TASK_BYTES = 128 << 20
#: Contents that leave a task in one batch, about.
BATCH_BYTES = 32 << 20


def open_path(path: str) -> tuple[fs.FileSystem, str, str]:
    """``(file system, path in it, what precedes that path in the URI)``."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path, ""
    if scheme == "file":
        inner = "/" + rest.lstrip("/")
        return fs.LocalFileSystem(), inner, path[:len(path) - len(inner)]
    system, inner = fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return system, inner, path[:len(path) - len(inner)] if path.endswith(inner) else f"{scheme}://"


def reachable(path: str) -> bool:
    """Whether Arrow has a file system for the path."""
    try:
        open_path(path)
        return True
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, inner, before = open_path(path)
            found = [i for i in system.get_file_info(fs.FileSelector(inner)) if not i.base_name.startswith(("_", "."))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([before + i.path for i in found], pa.string()), pa.array([i.type == fs.FileType.Directory for i in found], pa.bool_()),
                 pa.array([i.size or 0 for i in found], pa.int64())], ["path", "is_dir", "size"])


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, size)`` of every file below a file, directory or glob, empty
    ones too; names that start with ``_`` or ``.`` are left out."""
    share_code(spark)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    statuses = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root) or []
    if not statuses:
        raise ValueError(f"no such path: {path}")
    level = spark.createDataFrame([(s.getPath().toString(), s.isDirectory(), s.getLen()) for s in statuses], SCHEMA)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/listing-{uuid.uuid4().hex}"
    depth = 0
    while True:
        level.write.parquet(f"{folder}/{depth}")
        level = spark.read.schema(SCHEMA).parquet(f"{folder}/{depth}")
        directories = level.where("is_dir")
        n = directories.count()
        if not n:
            break
        tasks = max(1, -(-n // DIRECTORIES_PER_TASK))
        level = directories.select("path").repartition(tasks).mapInArrow(_list, SCHEMA)
        depth += 1
    return spark.read.schema(SCHEMA).parquet(*[f"{folder}/{k}" for k in range(depth + 1)]).where("not is_dir").select("path", "size")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    paths, contents, size = [], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], ["path", "content"])

    for part in batches:
        for path in part.column("path").to_pylist():
            system, inner, _ = open_path(path)
            with system.open_input_stream(inner, compression=None) as stream:
                contents.append(stream.read())
            paths.append(path)
            size += len(contents[-1])
            if size >= BATCH_BYTES:
                yield batch()
                paths, contents, size = [], [], 0
    if paths:
        yield batch()


def read_files(files: DataFrame) -> DataFrame:
    """``(path, content)`` of files given as ``(path, size)``."""
    spark = files.sparkSession
    total = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    slots = min(total["n"], 2 * spark.sparkContext.defaultParallelism)
    tasks = max(1, slots, -(-total["bytes"] // TASK_BYTES))
    return files.select("path").repartition(tasks).mapInArrow(_read, "path string, content binary")


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the empty files below a path, walked by the driver with Hadoop's
    file systems: for storage that ``reachable`` rules out."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in system.globStatus(root) or []:
        found = system.listFiles(status.getPath(), True)
        while found.hasNext():
            entry = found.next()
            if entry.getLen() == 0 and not entry.getPath().getName().startswith(("_", ".")):
                out.append(entry.getPath().toString())
    return out
