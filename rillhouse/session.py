"""Session settings and the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "rillhouse", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew splitting and disk-backed streaming state."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        STATE_PROVIDER: DISK_STATE,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def disk_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start within keep their state on disk, whatever the session says; stateful steps with timers can do no other.

    A query that has a checkpoint goes on with the kind of state it began with.
    """
    before = spark.conf.get(STATE_PROVIDER)
    spark.conf.set(STATE_PROVIDER, DISK_STATE)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left behind: their shuffle files stay on the executors' disks until the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors reach")
    folder = tempfile.mkdtemp(prefix="rillhouse-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder
