"""Merkle manifest of a table as postorder append logs.

Trees have eight children a node.  Rows become leaves, ranked within their
tree; every aligned run of ``8^HEIGHT`` leaves goes to one builder, which appends
each node to its log segment as soon as the node's last child is there.  That
is postorder, so a node's place needs no index.  Before leaf ``r`` stand ``r``
leaves and, of each level ``l``, ``floor(r / 8^l)`` finished nodes; a node of
level ``l`` whose last leaf is ``e`` follows that leaf by ``l`` places.
Siblings are read from the segment at these places.

Segment roots are the leaves of the next tier of logs, until each tree has one
segment.  The roots of all trees are the leaves of one more tree.  Paths then
go down from the last tier: a segment hands each of its leaves the siblings up
to the root, so that only one path per segment moves between tiers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import written

FAN = 8
#: Levels above the leaves in one segment; a full one has 4,096 leaves.
HEIGHT = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a leaf holds, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ---------------------------------------------------------------- positions

def leaf_place(rank: int) -> int:
    """Place of leaf ``rank`` in a postorder log."""
    place = rank
    while rank:
        rank //= FAN
        place += rank
    return place


def node_place(level: int, index: int, n: int) -> int:
    """Place of node ``index`` of ``level`` in the log of ``n`` leaves."""
    last = min((index + 1) * FAN ** level, n) - 1
    return leaf_place(last) + level


def height_of(n: int) -> int:
    """Levels above ``n`` leaves: nodes are joined while several remain."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def digest(children: list[bytes]) -> bytes:
    """Hash of the children's hex texts."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def append_nodes(leaves: list[bytes], height: int) -> list[bytes]:
    """The log of a tree of ``height`` levels above ``leaves``: every node
    follows its last child."""
    log: list[bytes] = []
    runs: list[list[bytes]] = [[] for _ in range(height + 1)]
    for rank, node in enumerate(leaves):
        level = 0
        log.append(node)
        runs[0].append(node)
        while level < height and (len(runs[level]) == FAN or rank == len(leaves) - 1):
            node = digest(runs[level])
            runs[level] = []
            level += 1
            log.append(node)
            runs[level].append(node)
    return log


def siblings(log: bytes, rank: int, n: int, height: int) -> list[tuple[int, list[bytes]]]:
    """Per level below ``height``: the leaf's own place in its run, and the
    run's other nodes from left to right."""
    out = []
    for level in range(height):
        index = rank // FAN ** level
        first = index - index % FAN
        count = min(FAN, -(-n // FAN ** level) - first)
        places = [node_place(level, first + k, n) for k in range(count) if first + k != index]
        out.append((index - first, [log[32 * p:32 * p + 32] for p in places]))
    return out


def pack_path(levels: list[tuple[int, list[bytes]]]) -> bytes:
    return b"".join(bytes([len(others), at]) + b"".join(others) for at, others in levels)


def unpack_path(path: bytes) -> list[tuple[int, list[bytes]]]:
    out, i = [], 0
    while i < len(path):
        n, at = path[i], path[i + 1]
        i += 2
        out.append((at, [path[i + 32 * k:i + 32 * k + 32] for k in range(n)]))
        i += 32 * n
    return out


def fold(node: bytes, levels: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that ``node`` and its siblings lead to."""
    for at, others in levels:
        node = digest([*others[:at], node, *others[at:]])
    return node


# ------------------------------------------------------------------- leaves

def leaf_text(columns: dict[str, Column]) -> Column:
    """Hashed text of a row: each field as byte count, colon and value, or ``-``."""
    parts = []
    for name in FIELDS:
        value = columns[name].cast("string")
        parts.append(F.when(value.isNull(), F.lit("-"))
                     .otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.concat(*parts)


def leaves(docs: DataFrame, changed: Callable[[dict[str, Column]], dict[str, Column]] | None = None) -> DataFrame:
    """``(tree, doc_id, leaf, changed)``: digests of every row, and of its
    ``changed`` form.  ``tree`` is the row's language so written that nulls
    come first and are a tree of their own."""
    columns = {name: F.col(name) for name in FIELDS}
    own = F.unhex(F.sha2(leaf_text(columns), 256))
    other = own if changed is None else F.unhex(F.sha2(leaf_text(columns | changed(columns)), 256))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), own.alias("leaf"), other.alias("changed"))


def ranked(items: DataFrame, order: list[str], label: str) -> DataFrame:
    """``items`` with ``rank``, their number within ``tree`` by ``order``.

    Rows are range-partitioned, so a tree may span any number of tasks; only
    one count per task and tree meets in a window.  ``order`` should end in a
    column that tells rows apart, lest equal rows share one task.
    """
    placed = items.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    at = written(placed.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), label)
    runs = at.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return at.join(runs, ["tree", "part"]).withColumn("rank", F.col("at") + F.col("shift")).drop("at", "part", "shift")


# --------------------------------------------------------------------- logs

ARROW = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string()}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], fields: list[tuple[str, str]], most: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.list_(ARROW[k[6:-1]]) if k.startswith("array<") else ARROW[k] for _, k in fields]
    names = [n for n, _ in fields]
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    for row in rows:
        held.append(row)
        if len(held) == most:
            yield batch()
            held = []
    if held:
        yield batch()


def _ddl(fields: list[tuple[str, str]]) -> str:
    return ", ".join(f"{n} {k}" for n, k in fields)


SEGMENT = [("tree", "string"), ("block", "long"), ("n", "long"), ("log", "binary"), ("root", "binary")]


def append_segments(nodes: DataFrame, notes: list[tuple[str, str]], label: str, height: int) -> DataFrame:
    """Written segments ``(tree, block, n, log, root, *notes)`` over
    ``(tree, rank, node, *notes)``; each note is an array by rank."""
    fields = SEGMENT + [(name, f"array<{kind}>") for name, kind in notes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def segments() -> Iterator[tuple]:
            for (tree, block), rows in groupby(_rows(batches), key=itemgetter(0, 1)):
                cols = list(zip(*rows))
                mine = list(cols[3])
                log = append_nodes(mine, segment_height(block, len(mine), height))
                yield tree, block, len(mine), b"".join(log), log[-1], *map(list, cols[4:])
        yield from _batches(segments(), fields, 16)

    names = [name for name, _ in notes]
    dealt = (nodes.select("tree", F.floor(F.col("rank") / FAN ** height).cast("long").alias("block"), "rank", "node", *names)
             .repartition("tree", "block").sortWithinPartitions("tree", "block", "rank"))
    return written(dealt.mapInArrow(run, _ddl(fields)), label)


def tiers(nodes: DataFrame, notes: list[tuple[str, str]], label: str, height: int) -> list[DataFrame]:
    """Segments of all tiers; the last has one segment a tree."""
    out = [append_segments(nodes, notes, label, height)]
    while (out[-1].agg(F.max("block")).first()[0] or 0) > 0:
        above = out[-1].select("tree", F.col("block").alias("rank"), F.col("root").alias("node"))
        out.append(append_segments(above, [], label, height))
    return out


PATH = [("tree", "string"), ("block", "long"), ("path", "binary"), ("subroot", "binary"), ("top", "binary")]


def segment_height(block: int, n: int, height: int) -> int:
    """Levels of a segment of ``n`` leaves: a tree with more than one segment
    has ``height`` levels in each, and only its first can look like a whole tree."""
    return height if block else height_of(n)


def paths_below(segments: DataFrame, paths: DataFrame, height: int, into: str | None = None) -> DataFrame:
    """The path of every leaf of ``segments``, keyed as a segment of the tier
    below: block = the leaf's rank, or with ``into`` the tree that this note
    names (its last tier's only segment, whose root is the leaf)."""
    met = segments.join(paths, ["tree", "block"])
    names = ["tree", "block", "n", "log", "path", "subroot", "top", *([into] if into else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for tree, block, n, log, path, subroot, top, *note in _rows(batches):
                levels = segment_height(block, n, height)
                for rank in range(n):
                    down = pack_path(siblings(log, rank, n, levels)) + path
                    if into:
                        at = 32 * leaf_place(rank)
                        yield note[0][rank], 0, down, log[at:at + 32], top
                    else:
                        yield tree, block * FAN ** height + rank, down, subroot, top
        yield from _batches(rows(), PATH, 512)

    return met.select(*names).mapInArrow(run, _ddl(PATH))


class Manifest:
    """Logs of a table: ``logs[0]`` holds its leaves, with their notes
    ``doc_id`` and ``changed``; ``tops`` are the logs over the trees' roots."""

    def __init__(self, docs: DataFrame, changed=None, height: int = HEIGHT):
        """``height``: levels in a segment.  A null in any column is part of the leaf; repeated rows are leaves
        of their own; an empty table has no trees."""
        self.height = height
        rows = written(leaves(docs, changed).withColumn("row", F.monotonically_increasing_id()), "leaves")
        # rows that share an id are ordered by their digests; "row" deals equal rows to several tasks
        nodes = ranked(rows, ["doc_id", "leaf", "row"], "ranked").withColumnRenamed("leaf", "node")
        self.logs = tiers(nodes, [("doc_id", "long"), ("changed", "binary")], "log", height)
        roots = self.logs[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"))
        self.tops = tiers(ranked(roots, ["name"], "subroots"), [("name", "string")], "top", height)

    def paths(self) -> DataFrame:
        """``(tree, block, path, subroot, top)`` of every segment in ``logs[0]``."""
        none = F.lit(None).cast("binary")
        paths = self.tops[-1].select("tree", "block", F.lit(b"").alias("path"), none.alias("subroot"), F.col("root").alias("top"))
        for segments in reversed(self.tops[1:]):
            paths = paths_below(segments, paths, self.height)
        paths = paths_below(self.tops[0], paths, self.height, "name")
        for segments in reversed(self.logs[1:]):
            paths = written(paths_below(segments, paths, self.height), "paths")
        return paths

    def proofs(self) -> DataFrame:
        """``(doc_id, leaf, subroot, root, proof, folded)`` per row, digests as
        bytes: ``proof`` is the packed path (per level the number of siblings,
        the own place among them, their digests) and ``folded`` the root that
        the changed leaf and the path lead to."""
        fields = [("doc_id", "long"), *((n, "binary") for n in ("leaf", "subroot", "root", "proof", "folded"))]
        met, height = self.logs[0].join(self.paths(), ["tree", "block"]), self.height

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                for block, n, log, ids, others, path, subroot, top in _rows(batches):
                    levels, above, known = segment_height(block, n, height), unpack_path(path), {}
                    for rank in range(n):
                        at, mine = 32 * leaf_place(rank), siblings(log, rank, n, levels)
                        node = fold(others[rank], mine)
                        if node not in known:
                            known[node] = fold(node, above)
                        yield ids[rank], log[at:at + 32], subroot, top, pack_path(mine) + path, known[node]
            yield from _batches(rows(), fields, 2048)

        return met.select("block", "n", "log", "doc_id", "changed", "path", "subroot", "top").mapInArrow(run, _ddl(fields))


def lower_third(columns: dict[str, Column]) -> dict[str, Column]:
    """The contract's tampering: A-Z of the text lower-cased where 3 divides
    the CRC-32 of the decimal ``doc_id``; a null id or text stays."""
    hit = F.coalesce(F.crc32(columns["doc_id"].cast("string").cast("binary")) % 3 == 0, F.lit(False))
    return {"text": F.when(hit, F.translate(columns["text"], UPPER, LOWER)).otherwise(columns["text"])}


def op11(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Manifest of whole ``documents``, a proof of each row and its check
    after tampering, in the contract's columns.

    Nulls are leaves' values (a null language is a tree of its own, first);
    rows that share a ``doc_id``, null ids first, are ordered by their leaves;
    texts of any length are hashed whole; other columns do not count; an empty
    table gives no rows.
    """
    proofs = Manifest(docs, lower_third, height).proofs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = [hashlib.sha256(b"".join(d for _, others in unpack_path(p) for d in others).hex().encode()).hexdigest()
                      for p in batch.column("proof").to_pylist()]
            cols = {n: [x.hex() for x in batch.column(n).to_pylist()] for n in ("leaf", "subroot", "root", "folded")}
            same = [a == b for a, b in zip(cols["root"], cols["folded"])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(cols[n], pa.string()) for n in ("leaf", "subroot", "root")),
                 pa.array(hashed, pa.string()), pa.array(cols["folded"], pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return proofs.mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                  "folded_root string, verified boolean")
