"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "footfall", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times. Partition counts are left to the cluster and AQE."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure_streaming(spark: SparkSession) -> None:
    """State in RocksDB (spills to disk, checkpoints as deltas); sessions pre-merged before the shuffle."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would exist on one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="footfall-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
