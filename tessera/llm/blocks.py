"""Packed blocks of documents, and notes that come back to them.

A block is one row that holds many documents in compact form.  Operators send
what has to meet by key as one packed row per block and key range, and get one
packed note per block and range back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PART_SCHEMA = "part int, kind int, block long, blob binary"
NOTE_SCHEMA = "block long, note int, blob binary"


def first_block_number() -> int:
    """Number of the running scan task's first block; later ones follow."""
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 24


def rows_of(schema: str, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    for at in range(0, len(rows), 256):
        cols = zip(*rows[at:at + 256])
        yield pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])


def dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, so that one block is unpacked at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def range_edges(parts: int) -> list[int]:
    """Inner borders of ``parts`` equal ranges of 64-bit hashes."""
    return [(k << 64) // parts for k in range(1, parts)]


def _slot(parts: int):
    """Evenly dealt: blocks of a scan task follow each other."""
    return F.pmod(F.shiftright("block", 24) + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)) * 7919, F.lit(parts)).cast("int")


def with_notes(blocks: DataFrame, notes: DataFrame, parts: int,
               fn: Callable[[dict, list[tuple[int, bytes]]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``fn(block row, its notes)`` per block: notes (``NOTE_SCHEMA``) and block
    rows meet in the block's slot, the notes first."""
    left = blocks.withColumn("note", F.lit(None).cast("int")).withColumn("blob", F.lit(None).cast("binary"))
    both = notes.select("block", "note", "blob").unionByName(left, allowMissingColumns=True)
    met = (both.withColumn("slot", _slot(parts)).repartitionById(parts, F.col("slot")).drop("slot")
           .sortWithinPartitions("block", F.asc_nulls_last("note")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        for row in dicts(batches):
            if row["note"] is not None:
                held.append((row["note"], row["blob"]))
            else:
                yield from fn(row, held)
                held = []

    return met.mapInArrow(run, schema)
