"""Bronze: land records as they came, with where they came from and what they hash to."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from strata.functions.text import record_hash
from strata.sources import layers

AUDIT_FIELDS = (
    T.StructField("ingestion_timestamp", T.TimestampType(), True),
    T.StructField("source_system", T.StringType(), True),
    T.StructField("source_file", T.StringType(), True),
    T.StructField("record_hash", T.StringType(), True),
)
AUDIT_COLUMNS = tuple(f.name for f in AUDIT_FIELDS)


def audit_schema(schema: T.StructType) -> T.StructType:
    """The declared table schema with the audit fields appended."""
    return T.StructType([*schema.fields, *AUDIT_FIELDS])


def with_audit_columns(
    df: DataFrame,
    ingested_at: datetime | Column,
    source_system: str | None = None,
    source_file: str | Column | None = None,
) -> DataFrame:
    """Add the audit columns to every row. One batch carries one ``ingested_at``, given by the caller."""
    file_col = source_file if isinstance(source_file, Column) else F.lit(source_file or "")
    stamp = ingested_at if isinstance(ingested_at, Column) else F.lit(ingested_at)
    return df.withColumns({
        "ingestion_timestamp": stamp,
        "source_system": F.lit(source_system or "unknown"),
        "source_file": file_col,
        "record_hash": record_hash(df.schema, exclude=AUDIT_COLUMNS),
    })


def ingest(
    df: DataFrame,
    ingested_at: datetime | Column,
    source_system: str | None = None,
    source_file: str | Column | None = None,
) -> tuple[DataFrame, Observation]:
    """Audited rows ready to append, and the row count the append itself will report.

    The count comes from the write, so the batch is not scanned a second time for it.
    """
    seen = Observation()
    audited = with_audit_columns(df, ingested_at, source_system, source_file)
    return audited.observe(seen, F.count(F.lit(1)).alias("records")), seen


def land(
    df: DataFrame,
    path: str,
    ingested_at: datetime | Column | None = None,
    source_system: str | None = None,
    source_file: str | Column | None = None,
    time_column: str | None = None,
    add_metadata: bool = True,
) -> int:
    """Append a batch to a bronze table and say how many rows it had; without ``add_metadata`` as it came."""
    if add_metadata:
        if ingested_at is None:
            raise ValueError("give the time of the batch, or land it without audit columns")
        df = with_audit_columns(df, ingested_at, source_system, source_file)
    return layers.land(df, path, "bronze", time_column)
