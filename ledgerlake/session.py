"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a deployment wants; each can be overridden by the caller or by spark-submit.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}

_local_folder: tempfile.TemporaryDirectory | None = None


def build(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``. A local session may go without the setting and
    then gets a folder of its own, removed when the process ends."""
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="ledgerlake-")
    return _local_folder.name


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder that nothing else uses, below the shared one."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
