"""Comparing the rows of each bucket without emitting its pairs.

A bucket with more than ``block`` rows is cut into hashed blocks and every pair
of blocks becomes its own group, so a hot bucket spreads over many tasks and
no task holds more than two blocks at a time.  Only what ``compare`` returns
for a chunk of whole groups (sums, spanning links) leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BLOCK_ROWS = 2048
CHUNK_ROWS = 1 << 16


def deal(keyed: DataFrame, block: int = BLOCK_ROWS) -> DataFrame:
    """Rows of ``keyed`` (``k``: bucket, ``id``, payload) that are not alone in
    their bucket, with ``lo``, ``hi`` (the pair of blocks) and ``side`` (the
    row's own block): a pair is to be counted only where ``lo = hi`` or the
    sides differ."""
    counts = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return (keyed.join(counts, "k")
            .withColumn("s", F.ceil(F.col("n") / block).cast("int"))
            .withColumn("side", F.pmod(F.xxhash64("id"), F.col("s")).cast("int"))
            .withColumn("t", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
            .withColumn("lo", F.least("side", "t")).withColumn("hi", F.greatest("side", "t"))
            .drop("t", "s", "n"))


def compare_buckets(keyed: DataFrame, compare: Callable[[pa.Table, np.ndarray], pa.RecordBatch],
                    schema: str, block: int = BLOCK_ROWS) -> DataFrame:
    """``compare_dealt`` of the buckets of ``keyed``.  Every row of ``keyed`` moves
    to be counted in its bucket, so a wide payload is better joined by ``id`` to
    what ``deal`` gives for keys and ids alone."""
    return compare_dealt(deal(keyed, block), compare, schema)


def compare_dealt(rows: DataFrame, compare: Callable[[pa.Table, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
    """Run ``compare(rows, group)`` over chunks of whole groups ``(k, lo, hi)``
    of what ``deal`` gave; ``group`` numbers the rows' groups in ascending order."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartition(parts, "k", "lo", "hi").sortWithinPartitions("k", "lo", "hi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                table = pa.Table.from_batches(held).combine_chunks()
                group = _groups(table)
                cut = int(np.searchsorted(group, group[-1]))
                if cut:
                    yield compare(table.slice(0, cut).combine_chunks(), group[:cut])
                    table = table.slice(cut).combine_chunks()
                held, size = table.to_batches(), table.num_rows
        if size:
            table = pa.Table.from_batches(held).combine_chunks()
            yield compare(table, _groups(table))

    return spread.mapInArrow(run, schema)


def _groups(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for name in ("k", "lo", "hi"):
        col = table[name].to_numpy()
        new[1:] |= col[1:] != col[:-1]
    return np.cumsum(new)


def pairs_in_groups(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs ``(i, j)``, i < j, of rows in the same group, one shift at a
    time: each step holds at most one pair per row."""
    i, shift = np.arange(len(group)), 1
    while True:
        i = i[i + shift < len(group)]
        i = i[group[i + shift] == group[i]]
        if not len(i):
            return
        yield i, i + shift
        shift += 1


def spanning(i: np.ndarray, j: np.ndarray, n: int, label: np.ndarray | None = None) -> np.ndarray:
    """Component label (smallest index) of each of ``n`` rows under links i-j,
    continuing from ``label``."""
    label = np.arange(n) if label is None else label
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = np.minimum(new, new[new])
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


class Links:
    """Collects links of a chunk and keeps only their components."""

    def __init__(self, n: int, most: int = 1 << 18):
        self.n, self.most, self.label = n, most, np.arange(n)
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            self.held.append((i, j))
            self.size += len(i)
            if self.size > self.most:
                self.fold()

    def fold(self) -> np.ndarray:
        if self.held:
            i, j = (np.concatenate(x) for x in zip(*self.held))
            # the links so far are kept as links to each row's label
            rows = np.flatnonzero(self.label != np.arange(self.n))
            i, j = np.concatenate([i, rows]), np.concatenate([j, self.label[rows]])
            self.label = spanning(i, j, self.n)
            self.held, self.size = [], 0
        return self.label
