"""Spark session defaults used by tests, the bench and the entry point.

On a cluster the session comes from the platform; ``configure`` only fills in
settings that are unset so a cluster's own choices (shuffle partitions,
checkpoint directory, broadcast threshold) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every pagelens job relies on for correct results.
REQUIRED_CONF = {
    # All timestamps are compared in UTC (oracle is UTC-naive DuckDB).
    "spark.sql.session.timeZone": "UTC",
    # map_concat / map_from_entries: later key wins (schema_merge, meta maps).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Performance defaults; only applied where the session has no value.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only small dimension sides; AQE may still switch at runtime
    # from measured sizes, never from guesses.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # transformWithStateInPandas needs the RocksDB provider.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "pagelens",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local session for tests/bench; on a cluster use the platform's session."""
    master = master or os.environ.get("PAGELENS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PAGELENS_DRIVER_MEM", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    for k, v in {**DEFAULT_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply required settings; fill performance defaults only where unset."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    for k, v in DEFAULT_CONF.items():
        try:
            if spark.conf.get(k, None) in (None, ""):
                spark.conf.set(k, v)
        except Exception:  # static conf that cannot change after start
            pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when a local session names none (tests) a fresh scratch folder is created
    and set; on a cluster a missing setting is an error, never a machine's own folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        d = tempfile.mkdtemp(prefix="pagelens-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
