"""Session helpers: recommended settings and the checkpoint location."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the operators are tuned for.  No broadcast is chosen from
# *estimated* sizes (a compressed-file estimate can be far below the real
# size); AQE re-plans joins at runtime from *measured* shuffle sizes --
# broadcast only below its threshold, otherwise sort-merge with skewed
# partitions split -- and coalesces small shuffle partitions.  Operators
# that know an exact row count hint broadcasts themselves.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def apply_recommended(spark: SparkSession) -> None:
    """Set the recommended SQL options that the session leaves open; what its
    owner has set stays."""
    for key, value in RECOMMENDED_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_code(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the
    driver found it; a cluster installs it (or gets it with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  When nothing is configured (a bare local session) we fall back to
    a folder below the session's warehouse directory, never a machine-local
    temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/_tessera_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
