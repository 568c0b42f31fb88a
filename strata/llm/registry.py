"""Queries of this subpackage, apart from those of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same question in DuckDB's SQL, where that can ask it."""

    def add(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(modulus: int, remainder: int = 2, id_col: str = "doc_id") -> Column:
    """Whether a document is held out: crc32 of its id as text leaves ``remainder``."""
    return F.crc32(F.col(id_col).cast("string")) % modulus == remainder
