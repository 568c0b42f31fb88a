"""Where jobs keep intermediate tables, and the session settings they are tuned for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Sessions on a cluster should start with these (the caller owns the session; nothing here sets them).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Start wide and let AQE merge small partitions: one setting for 1 GB and for 100 TB.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a temporary folder,
    because there every task runs on this machine.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared work folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/strata-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application put there; frames that read it are of no use afterwards."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(sc._jsc.hadoopConfiguration()).delete(root, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors, unlike cached blocks."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)
