"""SimHash near-duplicates with the pigeonring filter.

Fingerprints: 64 majority bits over XXH64 (seed 42) of word shingles.  Two
fingerprints within ``max_bits`` = 3 differing bits, seen as a ring of four
16-bit segments, have a segment from which every chain of l consecutive
segments differs in at most ``floor(l * 3 / 4)`` bits: 0, 1, 2, 3.  The first
two steps of that chain give the bucket key: an equal segment, and a next
segment equal outside one of its four nibbles (28 bits in all).  The longer
chains prune the pairs of a bucket before the full Hamming check.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .buckets import Links, compare_buckets, pairs_in_groups
from .common import per_batch, spread_join, text_parts, unused, written
from .components import connected_components

SEGMENTS, SEGMENT_BITS = 4, 16
STEP = 1 << 14


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority fingerprint of one UTF-8 text (0 without words)."""
    words = text.lower().split()  # on bytes: A-Z, and white space 09-0D and 20
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    if n <= 1:
        return digest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:n].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + STEP], stops[at:at + STEP])], ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints_of(texts: pa.Array, shingle: int, seed: int) -> pa.Array:
    raw, at = text_parts(texts)
    data, at = raw.tobytes(), at.tolist()
    fps = np.array([fingerprint(data[a:b], shingle, seed) for a, b in zip(at, at[1:])], np.uint64)
    return pa.array(fps.view(np.int64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(id, fp)``: the fingerprint of every row as a signed long."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), _fingerprints_of(batch.column(1), shingle, seed)], ["id", "fp"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(per_batch(run), "id long, fp long"))


def _segment(fp, i: int):
    return F.shiftrightunsigned(fp, 48 - 16 * (i % SEGMENTS)).bitwiseAND(F.lit(0xFFFF).cast("long"))


def ring_keys(fp) -> list:
    """The 16 bucket keys of a fingerprint: chain start and free nibble, the
    equal segment, the next segment without that nibble."""
    keys = []
    for start in range(SEGMENTS):
        for nibble in range(4):
            rest = _segment(fp, start + 1).bitwiseAND(F.lit(0xFFFF ^ (0xF << (4 * nibble))).cast("long"))
            keys.append(F.lit((start * 4 + nibble) << 32).cast("long")
                        .bitwiseOR(F.shiftleft(_segment(fp, start), 16)).bitwiseOR(rest))
    return keys


def _compare(max_bits: int):
    budgets = [l * max_bits // SEGMENTS for l in range(1, SEGMENTS + 1)]

    def run(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        ids, fps = rows["id"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
        start = (rows["k"].to_numpy() >> 34).astype(np.uint64)
        links = Links(len(ids))
        for i, j in pairs_in_groups(group):
            diff = fps[i] ^ fps[j]
            turn = start[i] * np.uint64(SEGMENT_BITS)  # the chain starts at the top of the turned word
            diff = np.where(turn > 0, (diff << turn) | (diff >> ((np.uint64(64) - turn) & np.uint64(63))), diff)
            keep = np.ones(len(i), bool)
            for l, most in enumerate(budgets, 1):
                chain = diff >> np.uint64(64 - SEGMENT_BITS * l)
                keep[keep] = np.bitwise_count(chain[keep]) <= most
            links.add(i[keep], j[keep])
        label = links.fold()
        at = np.flatnonzero(label != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[label[at]])], ["a", "b"])

    return run


def _grouped(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, group, component)`` of every distinct fingerprint in ``(id, fp)``:
    a key of its group and the least id there, null where no row of it has one."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the ring keys cover at most 3 bits")
    # inside, each distinct fingerprint has a key of its own; ids may be null or repeat
    distinct = written(fps.groupBy("fp").agg(F.min("id").alias("first")).withColumn("id", F.monotonically_increasing_id()), "distinct")
    keyed = distinct.select(F.explode(F.array(*ring_keys(F.col("fp")))).alias("k"), "id", "fp")
    comps = connected_components(compare_buckets(keyed, _compare(max_bits), "a long, b long"))
    classes = written(distinct.join(comps, F.col("id") == F.col("node"), "left")
                      .select("fp", "first", F.coalesce("component", "id").alias("group")), "classes")
    least = written(classes.groupBy("group").agg(F.min("first").alias("component")), "least")
    return written(spread_join(classes, least, "group").select("fp", "group", "component"), "groups")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``(id, fp, component)`` per row: rows whose fingerprints are linked,
    directly or through others, at ``max_bits`` or fewer differing bits share
    the smallest id.  ``max_bits`` is at most 3.

    A null text counts as empty (fingerprint 0, linked like any other); rows
    with a null id link and are linked through like others, and have a null
    component only where no row of the group has an id; repeated rows are
    kept; texts are read whole; other columns are ignored; an empty table
    gives an empty one.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return spread_join(fps, _grouped(fps, max_bits), "fp").select("id", "fp", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
               max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each group, all columns kept.

    The row of the smallest id stays, of rows with that id the one whose text
    has the least hash, once where it repeats.  Rows that share an id but not a
    group do not affect each other.  A row without an id stays only where no
    row of its group has one.  A null text counts as empty; an empty table
    gives an empty one.
    """
    mark = unused("text_hash", docs.columns)
    hashed = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = hashed.select(F.col(id_col).cast("long").alias("id"), F.col(mark).alias("hash"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _fingerprints_of(batch.column(2), shingle, 42)], ["id", "hash", "fp"])

    fps = written(rows.mapInArrow(per_batch(run), "id long, hash long, fp long"), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    first = (spread_join(fps, _grouped(fps.select("id", "fp"), max_bits), "fp")
             .groupBy("group").agg(F.min(order).alias("first")).select("first.id", "first.hash"))
    first = written(first, "first")
    kept = hashed.join(first, F.col(id_col).eqNullSafe(first["id"]) & (F.col(mark) == first["hash"]), "left_semi")
    return kept.dropDuplicates([id_col, mark]).select(*docs.columns)


def op10(docs: DataFrame) -> DataFrame:
    """Contract columns of ``near_duplicates`` over whole ``documents``."""
    found = near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"),
                        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))
