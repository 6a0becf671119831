"""Session construction and cluster-safe checkpoint handling."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a job that may run on a large cluster.  AQE re-plans joins at
# runtime (broadcast only when the *measured* shuffle output is small), merges
# tiny shuffle partitions and splits skewed ones (a basket or a store holding a
# large share of all rows).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "trolley", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master
    without it (tests) gets a private scratch folder; on a cluster that folder
    would be one machine's, so its absence is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="trolley-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss), never a local one.  The input is persisted first so the checkpoint
    write reads the computed blocks instead of recomputing the plan."""
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def written(df):
    """``df`` written as parquet into the shared checkpoint folder and read back.

    For wide frames of narrow values that several steps read, each some columns:
    a checkpoint holds serialised rows, which every reader takes whole.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
