"""Near-duplicate embeddings by cross-polytope hashing.

A vector is padded to a power of two and turned by three rounds of random signs
and a fast Hadamard transform; its hash is the coordinate of largest size with
its sign.  A bucket joins ``width`` such hashes, and each vector also stands in
the buckets where one hash is its second best (multiprobe).  Exact copies are
one entry with a count.

Buckets are made of ids alone.  Those with more than one get a sketch beside
each id, ``SKETCH`` signs of random projections, and only rows whose sketch is
near that of another row of the bucket are verified: their vectors follow, and
pairs are compared by their cosine in double precision.  A sketch rules out a pair at the
threshold with a probability of about one in 10^9.  A pair met in several
buckets counts in the first they share.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .buckets import Links, compare_dealt, deal, pairs_in_groups
from .common import per_batch, spread_join, written
from .components import connected_components

COSINE = 0.95
TABLES, SEED = 8, 17
SKETCH = 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (width a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x


def bucket_width(n: int, dim: int) -> int:
    """Hashes per bucket: so many that most vectors without a neighbour are alone."""
    return max(1, math.ceil(math.log(max(2, 4 * n)) / math.log(2 * max(2, dim))))


def sketches(x: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Signs of random projections, packed: ``(rows, SKETCH / 8)``."""
    plane = np.random.default_rng([seed, x.shape[1], 1]).normal(size=(x.shape[1], SKETCH))
    return np.packbits(x @ plane > 0, axis=1)


def sketch_bound(least: float) -> int:
    """Differing signs that pairs of cosine ``least`` stay below: six deviations above the mean."""
    share = math.acos(least) / math.pi
    return math.ceil(SKETCH * share + 6 * math.sqrt(SKETCH * share * (1 - share)))


def probes(x: np.ndarray, width: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """Buckets of each row, ``(rows, tables, width + 1)``: the best one, then
    for each hash the one with its second best coordinate."""
    n, dim = x.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = x
    out = np.zeros((n, tables, width + 1), np.int64)
    rng = np.random.default_rng([seed, size])
    for t in range(tables):
        first, second = [], []
        for _ in range(width):
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size))
            top = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            rows = np.arange(n)
            swap = np.abs(y[rows, top[:, 0]]) < np.abs(y[rows, top[:, 1]])
            top[swap] = top[swap][:, ::-1]
            sign = y[rows[:, None], top] < 0
            first.append(2 * top[:, 0] + sign[:, 0])
            second.append(2 * top[:, 1] + sign[:, 1])
        for p in range(width + 1):
            key = np.full(n, t, np.int64)
            for k in range(width):
                key = key * (2 * size) + (second[k] if p == k + 1 else first[k])
            out[:, t, p] = key
    return out


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    # scaled by the largest component first, so that squares stay in range
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _maybe(most: int):
    """Rows of each group whose sketch is within ``most`` signs of another row's."""
    def run(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(len(group), -1)
        dims, near = rows["dim"].to_numpy(), np.zeros(len(group), bool)
        for i, j in pairs_in_groups(group):
            for a in range(0, len(i), 1 << 16):
                p, q = i[a:a + (1 << 16)], j[a:a + (1 << 16)]
                ok = (dims[p] == dims[q]) & (np.bitwise_count(sketch[p] ^ sketch[q]).sum(axis=1) <= most)
                near[p[ok]] = near[q[ok]] = True
        return pa.RecordBatch.from_arrays([pa.array(rows[c].to_numpy()[near]) for c in MAYBE], MAYBE)

    return run


MAYBE = ["k", "lo", "hi", "side", "id", "bucket"]


def _compare(least: float):
    def run(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        ids, times, dims = (rows[c].to_numpy() for c in ("id", "times", "dim"))
        lo, hi, side, bucket = (rows[c].to_numpy() for c in ("lo", "hi", "side", "bucket"))
        raw, marks = rows["vector"].to_pylist(), rows["marks"].to_pylist()
        links, count = Links(len(ids)), np.zeros(len(ids), np.int64)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = _unit([raw[i] for i in at])
            met = np.stack([np.frombuffer(marks[i], np.int64) for i in at]).reshape(len(at), TABLES, -1)
            for i, j in pairs_in_groups(group[at]):
                for a in range(0, len(i), 1 << 14):
                    p, q = i[a:a + (1 << 14)], j[a:a + (1 << 14)]
                    ok = np.einsum("ij,ij->i", x[p], x[q]) >= least
                    p, q = p[ok], q[ok]
                    if not len(p):
                        continue
                    links.add(at[p], at[q])
                    # the first table and least bucket that both stand in
                    same = met[p][:, :, :, None] == met[q][:, :, None, :]
                    table = same.any((2, 3)).argmax(1)
                    k = np.arange(len(p))
                    least_bucket = np.where(same[k, table].any(2), met[p][k, table], np.iinfo(np.int64).max).min(1)
                    new = (least_bucket == bucket[at[p]]) & ((lo[at[p]] == hi[at[p]]) | (side[at[p]] != side[at[q]]))
                    np.add.at(count, at[p[new]], times[at[q[new]]])
                    np.add.at(count, at[q[new]], times[at[p[new]]])
        label = links.fold()
        keep = np.flatnonzero((count > 0) | (label != np.arange(len(ids))))
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(ids[label[keep]]), pa.array(count[keep])], ["a", "b", "n"])

    return run


INDEX_SCHEMA = "id long, vector binary, times long, dim int, buckets array<long>, marks binary, sketch binary"
INDEX = [f.split()[0] for f in INDEX_SCHEMA.split(", ")]


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    least: float = COSINE) -> DataFrame:
    """``(id, n_links, component)`` per row.

    ``n_links`` counts the other rows linked directly (copies each count),
    ``component`` is the smallest id reachable.  Vectors that are null, empty,
    zero or hold a null or non-finite component link with nothing; vectors of
    different lengths never link; rows may repeat (equal rows link); a row
    with a null id counts like any other, and ``component`` is null only where no
    id is reachable; other columns are ignored.
    """
    v = F.col("v")
    usable = F.coalesce(v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
                        & F.exists(v, lambda c: c != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        # adding 0.0 makes negative zeros positive, so that copies are equal as bytes
        packed = [(np.asarray(x, np.float64) + 0.0).tobytes() for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "vector"])

    good = written(rows.where(usable).mapInArrow(per_batch(pack), "id long, vector binary"), "vectors")
    distinct = written(good.groupBy("vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("times"))
                       .withColumn("id", F.monotonically_increasing_id()).withColumn("dim", (F.length("vector") / 8).cast("int")), "distinct")
    widths = {r.dim: bucket_width(r.n, r.dim) for r in distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, raw, dims = (batch.column(c) for c in ("id", "vector", "dim"))
        dims, raw = dims.to_numpy(), raw.to_pylist()
        marks: list = [None] * len(raw)
        signs: list = [None] * len(raw)
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = _unit([raw[i] for i in at])
            for i, m, s in zip(at, probes(x, widths[int(dim)]), sketches(x)):
                marks[i], signs[i] = m.tobytes(), s.tobytes()
        return pa.RecordBatch.from_arrays([ids, batch.column("vector"), batch.column("times"), batch.column("dim"),
                                           pa.array([list(np.frombuffer(m, np.int64)) for m in marks], pa.list_(pa.int64())),
                                           pa.array(marks, pa.binary()), pa.array(signs, pa.binary())], INDEX)

    indexed = written(distinct.mapInArrow(per_batch(index), INDEX_SCHEMA), "index")
    keyed = (indexed.select("id", "dim", F.explode("buckets").alias("bucket"))
             .select("id", "bucket", F.xxhash64("dim", "bucket").alias("k")))
    near = written(compare_dealt(deal(keyed).join(indexed.select("id", "dim", "sketch"), "id"), _maybe(sketch_bound(least)),
                                 "k long, lo int, hi int, side int, id long, bucket long"), "near")
    found = written(compare_dealt(near.join(indexed.select("id", "vector", "times", "dim", "marks"), "id"), _compare(least),
                                  "a long, b long, n long"), "links")
    comps = connected_components(found)
    counts = found.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    # inside, each distinct vector has a key of its own; ids may be null
    grouped = written(distinct.join(counts, "id", "left").join(comps.withColumnRenamed("node", "id"), "id", "left")
                      .select("vector", "first", (F.coalesce("n", F.lit(0)) + F.col("times") - 1).alias("n_links"),
                              F.coalesce("component", "id").alias("group")), "groups")
    least_id = written(grouped.groupBy("group").agg(F.min("first").alias("component")), "least")
    classes = written(spread_join(grouped, least_id, "group").select("vector", "n_links", "component"), "classes")
    linked = spread_join(good, classes, "vector").select("id", "n_links", "component")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone)


def op3(vectors: DataFrame) -> DataFrame:
    """Links and groups of every ``embeddings`` row, in the contract's columns;
    see ``near_duplicates`` for nulls, repeated rows and empty tables."""
    found = near_duplicates(vectors)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
