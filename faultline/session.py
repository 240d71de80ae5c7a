"""Session settings for running the analyses at scale.

On a cluster the session comes from the cluster; ``tune`` only sets values
that are not already set, so a cluster's own choices win. ``build_session``
is for tests and the local bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. Broadcast joins are size-checked: Spark (and AQE
# at runtime, from real shuffle statistics) broadcasts a side only below the
# threshold and falls back to a sort-merge join above it. Before a run the size
# is a guess from compressed files and declared column widths (keys of 9 million
# orders: 15 to 32 MB guessed, 144 MB as rows, which a driver must hold several
# times), so that threshold is far below the one for measured sizes.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot document in the line-item / order join even when the
    # per-document aggregate above it then needs its own shuffle: the extra
    # shuffle runs after map-side partial aggregation, a single hot task does not.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


_TUNED: set[str] = set()


def session_key(spark: SparkSession) -> str:
    """Identity of a session that is never reused by a later session."""
    try:
        return f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
        return f"session-{spark.session_id}" if hasattr(spark, "session_id") else f"obj-{id(spark)}"


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001 - no SparkContext on a Connect client
        return False


def tune(spark: SparkSession) -> SparkSession:
    key = session_key(spark)
    if key in _TUNED:
        return spark
    _TUNED.add(key)
    conf = spark.conf
    for k, v in SCALE_DEFAULTS.items():
        try:
            if conf.get(k, None) in (None, ""):
                conf.set(k, v)
        except Exception:  # noqa: BLE001 - a setting the session does not allow
            pass
    if _is_local(spark):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: point it at the cluster's shared storage")
        configured = tempfile.mkdtemp(prefix="faultline-ckpt-")  # local runs and tests only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "faultline") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
