"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when an aggregate above it wants the same
    # partitioning; one more small shuffle is cheaper than one giant task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings the operators are written for."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder path for ``purpose`` under the cluster's checkpoint folder.

    Only a local session, where every task sees the same disk, may fall back to
    a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="ackline-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to a table in the working folder and read it back.

    For results that several branches of a plan read: the plan above starts from
    a columnar scan, and a lost executor costs a re-read, not a recomputation.
    """
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
