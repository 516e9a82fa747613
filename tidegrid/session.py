"""Session settings, and durable (shared-storage) cut points for long lineages."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library was tuned with.  None of them is needed for right results.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidegrid", master: str | None = None,
                  **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only when neither the setting nor a checkpoint folder exists (a local test) is a
    temporary one made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if configured is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tidegrid-"))
    return configured or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`shared_dir`."""
    return f"{shared_dir(spark).rstrip('/')}/tidegrid-{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and read it from there.

    Used where two later steps must see the very same rows, or a small table would
    otherwise be computed twice.  Lost executors cost nothing but a re-read.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()
