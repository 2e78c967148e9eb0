"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

#: Shuffles start with many partitions, whatever the table; adaptive execution joins those that stay small.
FIRST_PARTITIONS = "2000"

_local_roots: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are written for; extra settings win.

    Without a number of shuffle partitions, shuffles start with ``FIRST_PARTITIONS``.
    """
    if "spark.sql.shuffle.partitions" not in settings:
        settings = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": FIRST_PARTITIONS, **settings}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tessera-")
    return _local_roots[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared root."""
    return f"{shared_root(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"
