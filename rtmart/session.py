"""Session and shared-folder helpers.

Library code never builds its own session: callers pass one. ``build_session``
exists for tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the warehouse relies on. AQE re-plans joins from runtime sizes and
# splits skewed shuffle partitions; the session time zone fixes every
# epoch-millis -> day/hour conversion (the reference used the JVM default zone).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Streaming state (dedup ids, join buffers, daily device sets) lives in
    # RocksDB: off the JVM heap, checkpointed incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A batch's users reach the state scan as a list of values.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "rtmart", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("RTMART_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    return jdir.get() if jdir.isDefined() else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a distributed file system path
    every executor can reach). Only a local-mode session without one -- tests,
    the bench, the smoke check -- gets a fresh folder of its own here.
    """
    found = _configured_checkpoint_dir(spark)
    if found:
        spark.sparkContext.setCheckpointDir(found)
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder "
            "(e.g. an HDFS/S3 path) before running rtmart jobs on a cluster")
    local_dir = tempfile.mkdtemp(prefix="rtmart-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local_dir)
    spark.sparkContext.setCheckpointDir(local_dir)
    return local_dir


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A session setting that holds within a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
