"""Join helpers.

Joins whose sides grow with the data are left to Catalyst/AQE: AQE measures
each shuffle stage and only then turns a join into a broadcast join (below
``spark.sql.adaptive.autoBroadcastJoinThreshold``) or splits skewed
partitions.  ``broadcast_if_bounded`` is for the cases where we already know
an exact row count and want the broadcast decided up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Upper bound on rows we are willing to ship to every executor when the
# count is known exactly (e.g. node counts, profile counts).
MAX_BROADCAST_ROWS = 2_000_000
# Sources with more distinct targets than this are "hot" when edges are
# co-partitioned by source; there are at most |E| / MIN_HOT_DEGREE of them.
MIN_HOT_DEGREE = 10_000
# Upper bound on the estimated in-memory size of a hinted broadcast.
MAX_BROADCAST_BYTES = 64 << 20
# Rows of the large side that one bucket (one task per iteration) holds.
BUCKET_ROWS = 4_000_000


def broadcast_if_bounded(df: DataFrame, known_rows: int | None,
                         limit: int | None = None, row_bytes: float = 16) -> DataFrame:
    """Hint a broadcast only when an exact row count is below ``limit``
    (default ``MAX_BROADCAST_ROWS``) and ``known_rows * row_bytes`` is below
    ``MAX_BROADCAST_BYTES``; otherwise leave the choice to AQE."""
    limit = MAX_BROADCAST_ROWS if limit is None else limit
    if (known_rows is not None and known_rows <= limit
            and known_rows * row_bytes <= MAX_BROADCAST_BYTES):
        return F.broadcast(df)
    return df


def hot_threshold(n_rows: int) -> int:
    """Rows per key above which a key is "hot"; keeps the number of hot keys
    at most ``MAX_BROADCAST_ROWS`` (there are at most n_rows / threshold)."""
    return max(MIN_HOT_DEGREE, n_rows // max(1, MAX_BROADCAST_ROWS))


def bucket_count(spark, n_rows: int) -> int:
    """Buckets for a table of ``n_rows`` rows: the shuffle partitions, and more
    where a bucket would otherwise hold over ``BUCKET_ROWS`` rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // BUCKET_ROWS))


def key_bytes(df: DataFrame) -> list:
    """Bytes of one row's values as a Column each: strings and binaries as they are, others 8."""
    return [F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.simpleString() in ("string", "binary") else F.lit(8)
            for f in df.schema.fields]


def measured(df: DataFrame) -> tuple[int, float]:
    """``(rows, bytes of an average row)``, counted."""
    width = F.lit(0)
    for c in key_bytes(df):
        width = width + c
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("double")).alias("b")).first()
    return row["n"], (row["b"] or 0.0) / max(1, row["n"])


#: Parts into which every row is dealt while the hot rows are told from the others.
SPLIT_PARTS = 64


class SkewSplitTable:
    """A large table joined once per iteration with a changing per-key table
    that is too large to broadcast (scores per node, colours per node).

    Rows of ordinary keys are written once as a table bucketed by the key
    (in the checkpoint folder, one file per bucket), so every later join
    shuffles only the per-key table.  Keys with more than ``hot_threshold(n_rows)``
    rows are "hot".  While their keys and ``payload_bytes`` of a per-key row
    each stay within ``MAX_BROADCAST_BYTES``, as measured, their per-key rows
    are broadcast and their large-table rows stay spread evenly.  Beyond that
    a hot key has a number of salts that grows with its rows: its large-table
    rows are bucketed by key and salt, and its per-key row is copied to every
    salt.  Either way a hot key never lands in one task.  Call ``close()`` to
    drop the bucketed tables.
    """

    def __init__(self, fact: DataFrame, keys: list[str], mat, n_rows: int, payload_bytes: int = 16):
        """``fact`` has to be stored (checkpointed or written): its rows are
        numbered in place when hot ones are salted."""
        spark = fact.sparkSession
        self.spark, self.keys, self.partitions = spark, list(keys), bucket_count(spark, n_rows)
        self.tables: list[tuple[str, str]] = []
        most = hot_threshold(n_rows)
        per_key = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        self.hot_keys = mat(per_key.where(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_salts")))
        self.n_hot, width = measured(self.hot_keys.select(*keys))
        self.salted = self.n_hot > MAX_BROADCAST_ROWS or self.n_hot * (width + payload_bytes) > MAX_BROADCAST_BYTES
        if self.salted:
            part = F.pmod(F.monotonically_increasing_id(), F.lit(SPLIT_PARTS)).cast("int")
            every = F.explode(F.sequence(F.lit(0), F.lit(SPLIT_PARTS - 1)))
            dealt = mat(fact.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", part)
                        .join(self.hot_keys.withColumn("_part", every), [*keys, "_part"], "left"))
            salt = F.pmod(F.floor(F.col("_row") / SPLIT_PARTS), F.col("_salts")).cast("int")
            self.cold = self._bucketed(dealt.where("_salts is null").select(*fact.columns), self.keys)
            self.hot = self._bucketed(dealt.where("_salts is not null").select(*fact.columns, salt.alias("_salt")), [*self.keys, "_salt"])
        else:
            self.cold = self._bucketed(fact.join(F.broadcast(self.hot_keys), self.keys, "left_anti"), self.keys)
            self.hot = mat(fact.join(F.broadcast(self.hot_keys.select(*keys)), self.keys))

        self.table, self.path = self.tables[0]

    def _bucketed(self, rows: DataFrame, by: list[str]) -> DataFrame:
        import uuid

        from ..session import ensure_checkpoint_dir

        table = f"tessera_bucketed_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{table}"
        self.tables.append((table, path))
        # the exchange hashes as buckets do, so each task writes one bucket file
        (rows.repartition(self.partitions, *by).write.bucketBy(self.partitions, *by).option("path", path).saveAsTable(table))
        return self.spark.table(table)

    def join(self, per_key: DataFrame) -> DataFrame:
        """Inner join of the large table with ``per_key`` on the keys."""
        cold = self.cold.join(per_key.repartition(self.partitions, *self.keys).hint("shuffle_hash"),
                              self.keys)
        if not self.salted:
            hot_rows = F.broadcast(per_key.join(F.broadcast(self.hot_keys.select(*self.keys)), self.keys))
            return cold.unionByName(self.hot.join(hot_rows, self.keys))
        salts = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_salt")
        copies = per_key.join(self.hot_keys, self.keys).select(*per_key.columns, salts)
        by = [*self.keys, "_salt"]
        return cold.unionByName(self.hot.join(copies.repartition(self.partitions, *by).hint("shuffle_hash"), by).drop("_salt"))

    def live(self) -> tuple:
        return (self.hot_keys,) if self.salted else (self.hot_keys, self.hot)

    def close(self) -> None:
        from .iterate import delete_path

        for table, path in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            delete_path(self.spark, path)
