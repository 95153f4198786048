"""SparkSession construction and the few session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job expects. Event times are wall-clock values, so the
# session zone is pinned; ANSI stays on (dirty text goes through try_cast).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Catalyst broadcasts a join side only when its size estimate is below
    # this bound; AQE re-checks with runtime sizes after each shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed state of any size, and timers, need the RocksDB store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "verdant",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage cuts.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system). Only in local mode, when the setting is missing, a scratch
    folder is created and recorded in the session; a cluster without the
    setting is an error.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="verdant-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder (a reliable
    checkpoint) and read it back, cutting the lineage, so an intermediate
    with several consumers is computed once."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location of one streaming query, under the shared folder."""
    return os.path.join(checkpoint_dir(spark), "streams", name)
