"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.cluster import scratch_path


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame written as Parquet and read again, and its path: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a stored table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
