"""Upkeep of partitioned Parquet tables that touches only what it must.

A delete rewrites the directories that hold matching rows, retention drops whole directories, and compaction packs small
files and leaves large ones where they are. All keep the table's layout. One job writes a table at a time; readers should
not run during the few moves and deletions at the end of a compaction, which can be finished after a crash.

Lists of directories and of small files pass through the driver; they are metadata, and ``MOST_FILES`` bounds a run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.cluster import scratch_path
from strata.sources import tables
from strata.sources.layers import partition_name, partition_value, with_partitions

Spec = Sequence[tuple[str, str]]

MOST_FILES = 100_000
_BITS = 6  # of a column in the curve
_PACKED, _MOVES = "_packed", "_moves"  # Spark's readers skip names that begin so


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _directory() -> Column:
    """Directory of a row's file, as a path: Spark names it as a URI."""
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "/[^/]*$", "")


def _directories(rows: DataFrame) -> list[str]:
    """Directories of the files that hold these rows."""
    return [r.d for r in rows.select(_directory().alias("d")).distinct().limit(MOST_FILES).collect()]


def _remove(spark: SparkSession, paths: Sequence[str]) -> None:
    if paths:
        fs, at = _fs(spark, paths[0])
        for path in paths:
            fs.delete(at(path), True)


def delete_where(spark: SparkSession, path: str, condition: Column | str, spec: Spec) -> int:
    """Delete the matching rows in place; the number of directories that were touched. A row whose condition is NULL stays.

    One scan finds the directories with a matching row. They alone are read again, put down without those rows, and
    replaced; directories that are left without rows are removed.
    """
    where = F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))
    rows = spark.read.parquet(path)
    touched = _directories(rows.where(where))
    if not touched:
        return 0
    names = [partition_name(*s) for s in spec]
    part = spark.read.option("basePath", path).schema(rows.schema).parquet(*touched)
    kept = scratch_path(spark, "kept")
    values = [F.col(n).cast("string") for n in names]
    held = part.select(*values, _directory()).distinct().collect()
    part.where(~where).drop(*names).write.parquet(kept)
    left = spark.read.parquet(kept)
    with_rows = {tuple(r) for r in with_partitions(left, spec).select(*values).distinct().collect()}
    tables.write(left, path, spec, "overwrite")
    _remove(spark, [r[-1] for r in held if tuple(r[:-1]) not in with_rows])
    return len(touched)


def purge_before(spark: SparkSession, path: str, time_column: str, oldest: Column, spec: Spec) -> int:
    """Remove the rows before a time for good; the number of directories that were dropped whole.

    Directories of earlier periods are dropped without reading a row. Only the one that the time falls into is rewritten.
    """
    own = [(n, t) for n, t in spec if n == time_column and t != "identity"]
    if not own:
        raise ValueError(f"the table is not laid out by {time_column}")
    name, value = partition_name(*own[0]), partition_value(oldest, own[0][1])
    out = _directories(spark.read.parquet(path).where(F.col(name).cast("string") < value))
    _remove(spark, out)
    edge = (F.col(name).cast("string") == value) & (F.col(time_column) < oldest)
    delete_where(spark, path, edge, spec)
    return len(out)


def along_curve(df: DataFrame, columns: Sequence[str]) -> Column:
    """The place of each row on a curve that is near in all columns at once where it is near: the bits of their ranks,
    taken in turn. Ranks are quantiles of the numbers or times, so uneven columns count alike."""
    shares = F.array(*[F.lit(k / 2 ** _BITS) for k in range(1, 2 ** _BITS)])
    cuts = df.agg(*[F.percentile_approx(c, shares, 1000).alias(c) for c in columns]).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType
        known = F.array(*[F.lit(v).cast(kind) for v in cuts[c] or []])
        rank = F.coalesce(F.size(F.filter(known, lambda v: v < F.col(c))), F.lit(0)).cast("long")
        for bit in range(_BITS):
            taken = F.shiftright(rank, bit).bitwiseAND(1)
            place = place + F.shiftleft(taken, bit * len(columns) + len(columns) - 1 - i)
    return place


def compact(spark: SparkSession, path: str, spec: Spec, order_by: Sequence[str], target_bytes: int = 128 << 20) -> int:
    """Pack the small files of each directory, those of less than half of ``target_bytes``, into files of about that size
    with narrow ranges of the numeric or time columns ``order_by``; the number of files that were packed.

    Directories with one small file are left alone, and so are all large files. New files are complete before an old one
    goes: they are moved in and the old ones removed from a list that is written first, and ``finish_compaction`` can do
    that again.
    """
    finish_compaction(spark, path)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select("path", "length").where(F.col("length") < target_bytes // 2)
             .withColumn("d", F.regexp_replace("path", "/[^/]*$", "")))
    crowded = files.groupBy("d").count().where("count > 1").select("d")
    small = files.join(crowded, "d", "left_semi").orderBy("path").limit(MOST_FILES).collect()
    if not small:
        return 0
    names = [partition_name(*s) for s in spec]
    rows = spark.read.option("basePath", path).schema(spark.read.parquet(path).schema).parquet(*[r.path for r in small])
    rows = with_partitions(rows.drop(*names), spec)
    count = max(1, -(-sum(r.length for r in small) // target_bytes))
    placed = rows.withColumn("_place", along_curve(rows, order_by))
    (placed.repartitionByRange(count, *names, "_place").sortWithinPartitions(*names, "_place").drop("_place")
     .write.mode("overwrite").option("compression", "zstd").partitionBy(*names).parquet(f"{path}/{_PACKED}"))
    spark.createDataFrame([(r.path,) for r in small], "path string").coalesce(1).write.parquet(f"{path}/{_MOVES}")
    finish_compaction(spark, path)
    return len(small)


def finish_compaction(spark: SparkSession, path: str) -> None:
    """Move packed files in and remove the small ones they replace, if a compaction has got that far; else drop its files."""
    fs, at = _fs(spark, path)
    try:
        old = [r.path for r in spark.read.schema("path string").parquet(f"{path}/{_MOVES}").collect()]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        fs.delete(at(f"{path}/{_PACKED}"), True)
        return
    root = fs.makeQualified(at(f"{path}/{_PACKED}"))
    if fs.exists(root):
        found = fs.listFiles(root, True)
        while found.hasNext():
            file = found.next().getPath()
            if file.getName().endswith(".parquet"):
                # As paths, not as text: names of directories may hold escaped characters.
                inner = root.toUri().relativize(file.toUri()).getPath()
                target = at(at(path), inner)
                fs.mkdirs(target.getParent())
                fs.rename(file, target)
    _remove(spark, old)
    for name in (_PACKED, _MOVES):
        fs.delete(at(f"{path}/{name}"), True)
