"""Plain Parquet tables written with Spark's own sinks.

A table is a path, or several paths with a layout each. What replaces rows writes a new path, which the caller puts in
the old one's place: readers of the old path are not disturbed, and a crashed write leaves it as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.sources.layers import partition_name, with_partitions


def write(df: DataFrame, path: str, spec: Sequence[tuple[str, str]] = (), mode: str = "append") -> None:
    """Append to a table, or with ``overwrite`` replace it (with a layout: the directories that the rows belong to).

    The rebalance hint gathers each directory's rows into files of the advised partition size.
    """
    names = [partition_name(*s) for s in spec]
    out = with_partitions(df, spec).hint("rebalance", *names) if spec else df
    writer = out.write.mode(mode).option("compression", "zstd")
    if names:
        writer = writer.partitionBy(*names).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def delete_where(spark: SparkSession, path: str, condition: Column | str, new_path: str) -> None:
    """The table without the matching rows, at a new path; a row whose condition is NULL stays."""
    where = F.expr(condition) if isinstance(condition, str) else condition
    spark.read.parquet(path).filter(~F.coalesce(where, F.lit(False))).write.option("compression", "zstd").parquet(new_path)


def compact(spark: SparkSession, path: str, sort_by: Sequence[str], new_path: str,
            target_bytes: int = 128 * 1024 * 1024) -> None:
    """The same rows at a new path, in files of about ``target_bytes`` with narrow ranges of the sort columns.

    Files are cut by ranges over the sort columns and a hash of the row, so that they stay even when one sort value
    fills most of the table.
    """
    rows = spark.read.parquet(path)
    count = max(1, -(-file_stats(spark, path).first()["size_bytes"] // target_bytes))
    order = [*sort_by, F.xxhash64(*[c for c, kind in rows.dtypes if not kind.startswith("map")])]
    (rows.repartitionByRange(count, *order).sortWithinPartitions(*sort_by)
     .write.option("compression", "zstd").parquet(new_path))


def read_layouts(spark: SparkSession, *paths: str) -> DataFrame:
    """Paths with different layouts as one table; a partition column that a path lacks is NULL there."""
    frames = [spark.read.parquet(p) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_stats(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows, bytes and files of the Parquet files below the paths. Files are listed, not read; rows are counted from
    their footers."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(list(paths)).select("path", "length"))
    rows = spark.read.option("recursiveFileLookup", "true").parquet(*paths).agg(F.count(F.lit(1)).alias("row_count"))
    sizes = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"), F.count(F.lit(1)).alias("file_count"))
    both = rows.unionByName(sizes, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("row_count", "size_bytes", "file_count")])
