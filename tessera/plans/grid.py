"""A sparse matrix dealt once into a grid of row blocks and column blocks.

Iterative fits join a large table of entries ``(row, col, ...)`` with two
changing tables, one per row and one per column, and sum back to both.  As two
keyed joins that shuffles every entry in every iteration.  Here the entries are
written once, bucketed by their cell in the grid; an iteration sends each row's
and each column's values to the cells that need them, and every cell answers
with sums per row and per column.  Only those move.

A row's values go to as many cells as there are column blocks, at most, and a
column's to as many as there are row blocks: where there are more columns than
rows, there are fewer row blocks than column blocks, so that less is sent.

A row with more than its block's even share of all entries would overload its
cells; its entries are dealt over all cells instead, and so are a column's.
There are fewer such rows than row blocks.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import ensure_checkpoint_dir, share_code
from .iterate import delete_path
from .joins import broadcast_if_bounded

ROW, COL = 0, 1
#: Entries of one cell on average, at most; a cell is held by one task.
CELL_ENTRIES = 500_000
#: Cells of one task, on average, at most, where the caller gives the blocks.
TASK_CELLS = 4
#: Bits of the mask that says to which cells a row's values go.
MASK_BITS = 62
EVERYWHERE = -1


def grid_side(spark, n_entries: int, cell_entries: int = CELL_ENTRIES) -> int:
    """Blocks per side: two cells for each task slot, more where cells would be too full."""
    return max(1, math.isqrt(_cells(spark, n_entries, cell_entries) - 1) + 1)


def _cells(spark, n_entries: int, cell_entries: int = CELL_ENTRIES) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, -(-n_entries // cell_entries))


def grid_shape(cells: int, n_rows: int, n_cols: int) -> tuple[int, int]:
    """Row and column blocks of ``cells`` cells or a few more that send the fewest copies of rows and columns."""
    rows = min(cells, max(1, round(math.sqrt(cells * max(1, n_rows) / max(1, n_cols)))))
    return rows, -(-cells // rows)


class SparseGrid:
    """``entries`` has ``row`` and ``col`` (longs) and payload columns.

    ``side``: row blocks and column blocks, more where cells would be too full
    (default: ``blocks``, their two numbers, or else by ``grid_shape``).
    ``hot_entries``: entries above which a row or column is dealt over all
    cells (default: a block's even share).  ``close()`` drops the stored table.
    """

    def __init__(self, entries: DataFrame, n_entries: int, side: int | None = None, hot_entries: int | None = None,
                 blocks: tuple[int, int] | None = None):
        spark = entries.sparkSession
        share_code(spark)
        self.spark = spark
        if side:
            side = max(side, math.isqrt(-(-n_entries // CELL_ENTRIES) - 1) + 1 if n_entries else 1)
            self.blocks = {ROW: side, COL: side}
        elif blocks:
            self.blocks = dict(zip((ROW, COL), blocks))
        else:
            n = entries.agg(F.approx_count_distinct("row").alias("r"), F.approx_count_distinct("col").alias("c")).first()
            self.blocks = dict(zip((ROW, COL), grid_shape(_cells(spark, n_entries), n["r"], n["c"])))
        # at most n / most keys of a kind are hot: never more than its blocks, unless the caller asks for more
        most = {kind: max(1, n_entries // blocks) if hot_entries is None else hot_entries for kind, blocks in self.blocks.items()}
        counts = [entries.groupBy(F.lit(kind).alias("kind"), F.col(name).alias("id")).agg(F.count(F.lit(1)).alias("n"))
                  for kind, name in ((ROW, "row"), (COL, "col"))]
        hot = counts[0].where(F.col("n") > most[ROW]).unionByName(counts[1].where(F.col("n") > most[COL])).collect()
        self.hot = {kind: [r["id"] for r in hot if r["kind"] == kind] for kind in (ROW, COL)}
        placed = entries.withColumn("cell", self._cell())
        cells = self.blocks[ROW] * self.blocks[COL]
        self.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-cells // TASK_CELLS) if blocks else math.isqrt(cells))
        self.table = f"tessera_grid_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{self.table}"
        (placed.repartition(self.buckets, "cell").write.bucketBy(self.buckets, "cell")
         .option("path", self.path).saveAsTable(self.table))

    def _block(self, key: Column, kind: int, salt: int | None = None) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(kind if salt is None else salt)), F.lit(self.blocks[kind])).cast("int")

    def _is_hot(self, key: Column, kind: int) -> Column:
        return key.isin(self.hot[kind]) if self.hot[kind] else F.lit(False)

    def _cell(self) -> Column:
        row, col = F.col("row"), F.col("col")
        row_block = F.when(self._is_hot(row, ROW), self._block(col, ROW, 2)).otherwise(self._block(row, ROW))
        col_block = F.when(self._is_hot(col, COL), self._block(row, COL, 3)).otherwise(self._block(col, COL))
        return row_block * self.blocks[COL] + col_block

    @property
    def entries(self) -> DataFrame:
        """The entries with their ``cell``, read in buckets."""
        return self.spark.table(self.table)

    def masks(self, kind: int, *also: Column) -> DataFrame:
        """``(id, mask, *also)`` per row or column; ``also`` are aggregates over its entries."""
        cols = self.blocks[COL]
        key, other = ("row", F.floor(F.col("cell") % cols)) if kind == ROW else ("col", F.floor(F.col("cell") / cols))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (other % MASK_BITS).cast("int"))
        rows = self.entries.groupBy(F.col(key).alias("id")).agg(F.bit_or(bit).alias("mask"), *also)
        return rows.withColumn("mask", F.when(self._is_hot(F.col("id"), kind), F.lit(EVERYWHERE).cast("long")).otherwise(F.col("mask")))

    def sent(self, rows: DataFrame) -> DataFrame:
        """A copy of ``rows`` (with ``kind``, ``id``, ``mask``) for each cell that needs it, with ``cell``."""
        n_rows, n_cols = self.blocks[ROW], self.blocks[COL]
        mask = F.col("mask")

        def some(n: int) -> Column:
            return F.filter(F.sequence(F.lit(0), F.lit(n - 1)),
                            lambda b: F.call_function("shiftright", mask, (b % MASK_BITS).cast("int")).bitwiseAND(F.lit(1)) == 1)

        row_cells = F.transform(some(n_cols), lambda b: self._block(F.col("id"), ROW) * n_cols + b)
        col_cells = F.transform(some(n_rows), lambda b: b * n_cols + self._block(F.col("id"), COL))
        own = F.when(F.col("kind") == ROW, row_cells).otherwise(col_cells)
        cells = F.when(mask == EVERYWHERE, F.sequence(F.lit(0), F.lit(n_rows * n_cols - 1))).otherwise(own)
        return rows.withColumn("cell", F.explode(cells)).drop("mask")

    def answer(self, sent: DataFrame, step: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``step(entries, values)`` per cell, both as Arrow tables."""
        sent = sent.select(*[F.col(c).alias(c) for c in sent.columns])  # may itself come from the entries
        return (self.entries.groupBy("cell")
                .cogroup(sent.repartition(self.buckets, "cell").groupBy("cell")).applyInArrow(step, schema))

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        delete_path(self.spark, self.path)


#: Entries of one packed cell on average, at most.
PACKED_ENTRIES = 1_000_000
#: Entries that a task packs at a time before they move.
CHUNK_ENTRIES = 1 << 18
MIX = np.int64(-7046029254386353131)
CHUNK = "cell int, row binary, col binary, x binary"
PACKED = "cell int, rows binary, row_at binary, cols binary, col_at binary, x binary"


class PackedGrid:
    """A matrix of ``(row, col, value)`` (two longs and a double) in cells that are stored as one row each.

    For products of the whole matrix with a vector.  Entries move once, packed
    by tasks into a row per cell; entries of one row and column add up.  A cell
    holds its distinct rows and columns, and for each entry their places among
    them, so that a product looks up a value per row or column of the cell.

    There are ``side`` column blocks (by default one: a row then lies in one
    cell, its value goes there only and its sum comes from there) and row blocks
    in number with the entries.  A cell's size is fixed, so what cells need and
    answer, their distinct rows and columns, grows as the entries do.  A column
    with over ``hot_entries`` entries is dealt over all column blocks, and a row
    that alone has more than the even share of a row block over all row blocks
    (there are fewer of these than row blocks).

    ``per_col`` is ``(col, n)``, ``n_cols`` its rows; ``close()`` drops the table.
    """

    def __init__(self, entries: DataFrame, n_entries: int, per_col: DataFrame, n_cols: int,
                 side: int | None = None, hot_entries: int | None = None):
        spark = entries.sparkSession
        share_code(spark)
        self.spark = spark
        cells = _cells(spark, n_entries, PACKED_ENTRIES)
        n_blocks = side or 1
        row_blocks = max(n_blocks, -(-cells // n_blocks))
        most = max(1, n_entries // row_blocks)
        long_rows = [r["row"] for r in entries.groupBy("row").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select("row").collect()]

        def block(key: str, salt: int, n: int) -> Column:
            return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(n)).cast("int")

        row_block = block("row", ROW, row_blocks)
        if long_rows:
            row_block = F.when(F.col("row").isin(long_rows), block("col", 2, row_blocks)).otherwise(row_block)
        col_block = F.lit(0)
        if n_blocks > 1:
            hot = per_col.where(F.col("n") > (n_entries // n_blocks if hot_entries is None else hot_entries)).select("col", F.lit(True).alias("hot"))
            entries = entries.join(broadcast_if_bounded(hot, n_cols), "col", "left")
            col_block = F.when(F.col("hot"), block("row", 3, n_blocks)).otherwise(block("col", COL, n_blocks))
        cell = (row_block * n_blocks + col_block).alias("cell")
        self.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_entries // (TASK_CELLS * PACKED_ENTRIES)))
        chunks = entries.select(cell, "row", "col", F.coalesce("value", F.lit(0.0)).alias("x")).mapInArrow(_chunks, CHUNK)
        self.table = f"tessera_packed_{uuid.uuid4().hex}"
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{self.table}"
        (chunks.repartition(self.buckets, "cell").groupBy("cell").applyInArrow(_packed_cell, PACKED)
         .write.bucketBy(self.buckets, "cell").option("path", self.path).saveAsTable(self.table))

    @property
    def cells(self) -> DataFrame:
        """The packed cells, read in buckets."""
        return self.spark.table(self.table)

    def routes(self, kind: int) -> DataFrame:
        """``(id, mask)``: the cells that hold a row, or a column."""
        ids = self.cells.select("cell", "rows" if kind == ROW else "cols").mapInArrow(_cell_ids, "id long, cell int")
        return ids.groupBy("id").agg(F.collect_list("cell").alias("mask"))

    def product(self, values: DataFrame, kind: int) -> DataFrame:
        """``(id, s)``: the matrix times ``v`` of columns (per row), or of rows (per
        column); ``values`` are ``(id, mask, v)`` with their cells as ``mask``."""
        sent = values.select(F.explode("mask").alias("cell"), "id", "v").repartition(self.buckets, "cell")
        answers = self.cells.groupBy("cell").cogroup(sent.groupBy("cell")).applyInArrow(_cell_product(kind), "id long, s double")
        return answers.groupBy("id").agg(F.sum("s").alias("s"))

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        delete_path(self.spark, self.path)


def _summed(keys: list[np.ndarray], x: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries sorted by their keys, of which the last comes first, with those of equal keys added up."""
    order = np.lexsort(keys)
    keys, x = [k[order] for k in keys], x[order]
    new = np.ones(len(x), bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.add.reduceat(x, at)


def _blobs(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column: the bytes of ``values`` between consecutive places ``at``."""
    offsets = (at * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _chunks(batches):
    """A task's entries, ``CHUNK_ENTRIES`` or a few more at a time, as one row per cell."""
    held: list[list[np.ndarray]] = []
    n = 0

    def packed() -> pa.RecordBatch:
        cell, row, col, x = (np.concatenate(c) for c in zip(*held))
        mixed = row * MIX ^ col
        if len(np.unique(mixed)) < len(mixed):  # some may be of one row and column
            (col, row, cell), x = _summed([col, row, cell], x)
        order = np.argsort(cell, kind="stable")
        cell, row, col, x = (c[order] for c in (cell, row, col, x))
        at = np.append(np.flatnonzero(np.append(True, cell[1:] != cell[:-1])), len(cell))
        return pa.RecordBatch.from_arrays([pa.array(cell[at[:-1]], pa.int32()), *(_blobs(v, at) for v in (row, col, x))], ["cell", "row", "col", "x"])

    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n += batch.num_rows
            if n >= CHUNK_ENTRIES:
                yield packed()
                held.clear()
                n = 0
    if held:
        yield packed()


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _packed_cell(chunks: pa.Table) -> pa.Table:
    """The chunks of one cell as its one row."""
    (row, col), x = _summed([_joined(chunks["row"], np.int64), _joined(chunks["col"], np.int64)], _joined(chunks["x"], np.float64))
    rows, row_at = np.unique(row, return_inverse=True)
    cols, col_at = np.unique(col, return_inverse=True)
    parts = {"rows": rows, "row_at": row_at.astype(np.int32), "cols": cols, "col_at": col_at.astype(np.int32), "x": x}
    return pa.table({"cell": chunks["cell"].slice(0, 1), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in parts.items()}})


def _cell_ids(batches):
    """``(id, cell)`` of the distinct rows, or columns, of packed cells."""
    for batch in batches:
        for cell, ids in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.full(len(ids), cell, np.int32))], ["id", "cell"])


def _cell_product(kind: int):
    """One cell's part of a product: sums per row of values of its columns, or the other way."""
    own, other = ("row", "col") if kind == ROW else ("col", "row")

    def run(cells: pa.Table, values: pa.Table) -> pa.Table:
        ids, sums = np.zeros(0, np.int64), np.zeros(0)
        if cells.num_rows and values.num_rows:
            cell = {name: _joined(cells[name], kind) for name, kind in (
                ("rows", np.int64), ("cols", np.int64), ("row_at", np.int32), ("col_at", np.int32), ("x", np.float64))}
            known, v = values["id"].to_numpy(), values["v"].to_numpy()
            order = np.argsort(known)
            known, v = known[order], v[order]
            place = np.minimum(np.searchsorted(known, cell[f"{own}s"]), len(known) - 1)
            held = np.where(known[place] == cell[f"{own}s"], v[place], 0.0)
            ids = cell[f"{other}s"]
            sums = np.bincount(cell[f"{other}_at"], held[cell[f"{own}_at"]] * cell["x"], len(ids))
        return pa.table({"id": pa.array(ids, pa.int64()), "s": pa.array(sums, pa.float64())})

    return run
