"""SQL over the layers' tables, with bound parameters."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def sql_query(
    spark: SparkSession, query: str, tables: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, Any] | None = None, limit: int | None = None,
) -> DataFrame:
    """Run SQL text. Tables stand in it as ``{name}`` (or are in the catalog), parameters as ``:name``.

    Parameters are bound, never pasted into the text. All rows come back unless ``limit`` caps them.
    """
    out = spark.sql(query, args=dict(params or {}), **dict(tables or {}))
    return out if limit is None else out.limit(limit)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Make a Parquet table at ``path`` known as ``layer.table``, so SQL text can name it."""
    layer, table = name.split(".")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
    spark.catalog.createTable(f"`{layer}`.`{table}`", path=path, source="parquet")
