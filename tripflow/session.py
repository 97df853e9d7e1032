"""Session building and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# What the library relies on. Everything else (executor sizes, shuffle
# partitions, broadcast threshold) belongs to the deployment.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def init_spark(app_name: str = "tripflow", config_params: dict | None = None) -> SparkSession:
    """Get or build a session under the defaults above and the given settings."""
    settings = {k: str(v) for k, v in (DEFAULTS | (config_params or {})).items()}
    return SparkSession.builder.appName(app_name).config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for written intermediates, visible to every executor.

    It lies under ``spark.checkpoint.dir``. Only a local master may fall back to
    the machine's own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tripflow-")
    return f"{base.rstrip('/')}/tripflow/{label}-{uuid.uuid4().hex}"
