"""Layer profiles, and reading and writing files the way each layer wants them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Layer:
    """Defaults of a layer's tables."""

    name: str
    codec: str
    transform: str
    retention_days: int
    properties: dict[str, str] = field(default_factory=dict)


# Codec, partitioning, retention and properties of the three layers.
LAYERS = {
    "bronze": Layer("bronze", "snappy", "day", 90, {"append.only": "true"}),
    "silver": Layer("silver", "zstd", "day", 730, {"data.quality.enforced": "true"}),
    "gold": Layer("gold", "zstd", "month", 2555, {"optimization": "analytics", "materialized": "true"}),
}

# How a partition transform is written in a directory name.
_TRANSFORM_FORMATS = {"year": "yyyy", "month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}


def partition_value(column: Column, transform: str) -> Column:
    """A partition value: the column itself, or the year, month, day or hour of a time as sortable text."""
    if transform == "identity":
        return column
    if transform not in _TRANSFORM_FORMATS:
        raise ValueError(f"unknown transform {transform!r}; use identity, {', '.join(_TRANSFORM_FORMATS)}")
    return F.date_format(column, _TRANSFORM_FORMATS[transform])


def partition_name(field_name: str, transform: str) -> str:
    return f"{field_name}_{transform}"


def with_partitions(df: DataFrame, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Add one ``<field>_<transform>`` column per ``(field, transform)``."""
    return df.withColumns({partition_name(f, t): partition_value(F.col(f), t) for f, t in spec})


def between(df: DataFrame, field_name: str, low: Column, high: Column, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows with ``low <= field < high``, also filtered on the partition columns made from the field.

    The extra predicate is what lets Spark skip directories: it does not derive it from the time column.
    """
    out = df.filter((F.col(field_name) >= low) & (F.col(field_name) < high))
    for name, transform in spec:
        if name == field_name and transform != "identity":
            part = F.col(partition_name(name, transform))
            out = out.filter((part >= partition_value(low, transform)) & (part <= partition_value(high, transform)))
    return out


def read_files(spark: SparkSession, path: str, file_format: str, schema: T.StructType, **options: str) -> DataFrame:
    """CSV, JSON or Parquet files with a declared schema.

    Lines that do not fit keep their text in ``_corrupt_record`` instead of failing the load or vanishing.
    """
    if file_format == "parquet":
        return spark.read.schema(schema).options(**options).parquet(path)
    if file_format not in ("csv", "json"):
        raise ValueError(f"unknown file format {file_format!r}; use csv, json or parquet")
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if file_format == "csv":
        reader = reader.option("header", "true")
    return reader.options(**options).format(file_format).load(path)


def ingest_files(
    spark: SparkSession, source: str, file_format: str, schema: T.StructType, target: str, layer: str = "bronze",
    time_column: str | None = None, transform: str | None = None, rejected: str | None = None, **options: str,
) -> tuple[int, int]:
    """Load files into a table of a layer; how many rows went in, and how many lines did not fit ``schema``.

    The load counts both while it writes. With ``rejected``, a path, lines that do not fit are added there: their text,
    what could be read of them, and their file. The files are read a second time only if there are such lines.
    """
    loaded = read_files(spark, source, file_format, schema, **options)
    if CORRUPT not in loaded.columns:
        loaded = loaded.withColumn(CORRUPT, F.lit(None).cast("string"))
    bad = F.col(CORRUPT).isNotNull()
    seen = Observation()
    counted = loaded.observe(seen, F.count_if(~bad).alias("landed"), F.count_if(bad).alias("rejected"))
    write_layer(counted.filter(~bad).drop(CORRUPT), target, layer, time_column, transform=transform)
    counts = seen.get
    if rejected is not None and counts["rejected"]:
        loaded.withColumn("source_file", F.col("_metadata.file_path")).filter(bad).write.mode("append").parquet(rejected)
    return counts["landed"], counts["rejected"]


def write_layer(
    df: DataFrame, path: str, layer: str, time_column: str | None = None, mode: str = "append",
    transform: str | None = None,
) -> None:
    """Write a table in its layer's codec, in directories by the layer's transform of ``time_column``.

    The rebalance hint gathers each directory's rows into files of the advised partition size and splits a
    directory that holds most of the batch over many tasks.
    """
    profile = LAYERS[layer]
    writer = df
    names: list[str] = []
    if time_column:
        spec = [(time_column, transform or profile.transform)]
        names = [partition_name(*spec[0])]
        writer = with_partitions(df, spec).hint("rebalance", *names)
    out = writer.write.mode(mode).option("compression", profile.codec).option("maxRecordsPerFile", 20_000_000)
    out.option("partitionOverwriteMode", "dynamic").partitionBy(*names).parquet(path)


def land(df: DataFrame, path: str, layer: str, time_column: str | None = None, mode: str = "append",
         transform: str | None = None) -> int:
    """Write a table of a layer, see ``write_layer``, and say how many rows went in.

    The write itself counts them, so nothing is read twice.
    """
    seen = Observation()
    write_layer(df.observe(seen, F.count(F.lit(1)).alias("records")), path, layer, time_column, mode, transform)
    return seen.get["records"]


def _from(df: DataFrame, column: str, low: Column, spec: Sequence[tuple[str, str]]) -> DataFrame:
    """Only the directories that can hold ``column >= low``."""
    for name, transform in spec:
        if name == column:
            df = df.filter(F.col(partition_name(name, transform)) >= partition_value(low, transform))
    return df


def oldest_kept(layer: str, as_of: Column) -> Column:
    """The time before which the layer's rows are out."""
    return as_of - F.make_dt_interval(F.lit(LAYERS[layer].retention_days))


def retained(df: DataFrame, layer: str, time_column: str, as_of: Column, spec: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Rows within the layer's retention at ``as_of``; with the table's layout, directories that are out are skipped."""
    oldest = oldest_kept(layer, as_of)
    return _from(df.filter(F.col(time_column) >= oldest), time_column, oldest, spec)


def newer_than(df: DataFrame, column: str, high_water: Any, spec: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Rows above the mark of the last run; without a mark, all rows.

    With the table's layout, directories below the mark are skipped: Spark does not derive that from the column.
    """
    if high_water is None:
        return df
    if isinstance(df.schema[column].dataType, T.TimestampNTZType) and isinstance(high_water, datetime):
        # A Python time would be taken as a moment in the session's time zone.
        high_water = F.lit(high_water.isoformat(sep=" ")).cast("timestamp_ntz")
    return _from(df.filter(F.col(column) > high_water), column, F.lit(high_water), spec)


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    """The mark to keep for the next run."""
    return df.agg(F.max(column).alias("high_water_mark"))


def scan(
    df: DataFrame, columns: Sequence[str] | None = None, where: Column | str | None = None,
    order_by: Sequence[str | Column] = (), limit: int | None = None,
) -> DataFrame:
    """Columns, predicate, order and cap. ``limit=0`` returns no rows; only an order makes a cap repeatable."""
    out = df if where is None else df.filter(where)
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out.select(*columns) if columns is not None else out


# Type changes every reader can follow.
_WIDENINGS = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
    ("int", "bigint"), ("float", "double"), ("int", "double"), ("date", "timestamp"), ("date", "timestamp_ntz"),
}


def read_as(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Old data under a newer schema: renamed, widened, missing columns NULL, dropped columns gone."""
    current = df.withColumnsRenamed(renames or {})
    have = {f.name: f.dataType.simpleString() for f in current.schema.fields}
    columns = []
    for f in schema.fields:
        want = f.dataType.simpleString()
        if f.name not in have:
            if not f.nullable:
                raise ValueError(f"new column {f.name!r} must be nullable: older rows have no value")
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == want or (have[f.name], want) in _WIDENINGS:
            columns.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name!r} cannot change from {have[f.name]} to {want}")
    return current.select(*columns)


def read_versions(versions: Sequence[tuple[DataFrame, dict[str, str]]], schema: T.StructType) -> DataFrame:
    """All schema versions of a table, read under the newest one."""
    frames = [read_as(df, schema, renames) for df, renames in versions]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
