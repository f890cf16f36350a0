"""Driver-loop helper for iterative operators.

Each iteration's state is materialised with a *reliable* checkpoint (written
to ``spark.checkpoint.dir``), which both cuts the lineage -- so planning time
stays flat -- and survives executor loss, unlike cached or local-checkpointed
blocks.  States that are no longer needed are released and their checkpoint
files deleted, so a long loop keeps only the live iterations on storage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import ensure_checkpoint_dir


def _checkpoint_file(df: DataFrame) -> str | None:
    try:
        opt = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        return opt.get() if opt.isDefined() else None
    except Exception:  # not a checkpointed frame
        return None


def delete_path(spark, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception:
        pass


class Materializer:
    """Checkpoints iteration states and deletes the ones released.

    With ``columnar`` they are written as Parquet beside the checkpoints
    instead: large states are smaller so, and reads take only their columns.
    """

    def __init__(self, spark, columnar: bool = False):
        ensure_checkpoint_dir(spark)
        self._spark = spark
        self._columnar = columnar
        self._live: list[DataFrame] = []
        self._paths: dict[int, str] = {}

    def __call__(self, df: DataFrame) -> DataFrame:
        if self._columnar:
            return self.table(df, "state")
        out = df.checkpoint(eager=True)
        self._live.append(out)
        return out

    def table(self, df: DataFrame, label: str = "stored", codec: str | None = None) -> DataFrame:
        """``df`` written as Parquet beside the checkpoints and read back: for a
        large input that is read often, a fraction of a checkpoint's bytes.
        ``codec`` compresses it, if not the session's."""
        path = f"{ensure_checkpoint_dir(self._spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path, compression=codec)
        out = self._spark.read.schema(df.schema).parquet(path)
        self._live.append(out)
        self._paths[id(out)] = path
        return out

    def release_all_but(self, *keep: DataFrame) -> None:
        """Drop every state not in ``keep``.  Only pass states whose lazy
        descendants are no longer needed."""
        keep_ids = {id(k) for k in keep}
        still = []
        for df in self._live:
            if id(df) in keep_ids:
                still.append(df)
                continue
            path = self._paths.pop(id(df), None) or _checkpoint_file(df)
            if path:
                delete_path(self._spark, path)
        self._live = still
