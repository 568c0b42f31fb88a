"""Operational metrics as tables: ingestion, messages, storage, job runs, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from strata.sources.tables import file_stats

# Upper bounds of the latency histogram in seconds.
LATENCY_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 2.0, 5.0)


def ingest_record(observed: Observation | Mapping[str, Any], source: str, layer: str, status: str,
                  at: datetime) -> dict[str, Any]:
    """One row for the metrics table, from what a write observed."""
    seen = observed.get if isinstance(observed, Observation) else observed
    return {"source": source, "layer": layer, "status": status, "records": seen["records"], "recorded_at": at}


def ingest_metrics(runs: DataFrame) -> DataFrame:
    """Records, bytes and errors by source, layer and status."""
    return runs.groupBy("source", "layer", "status").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes"),
        F.count_if(F.col("status") != "success").alias("errors"))


def message_counts(log: DataFrame) -> DataFrame:
    """Messages by topic and status."""
    return log.groupBy("topic", "status").agg(F.count(F.lit(1)).alias("messages"))


def latency_histogram(log: DataFrame, latency: Column, by: Sequence[str],
                      buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Cumulative histogram: how many messages took at most ``le`` seconds; NULL is the open end.

    All buckets come from one aggregate row per group.
    """
    counts = [F.count_if(latency <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(buckets)]
    wide = log.groupBy(*by).agg(*counts, F.count(latency).alias("_all"))
    rows = [F.struct(F.lit(b).cast("double").alias("le"), F.col(f"_b{i}").alias("messages"))
            for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("_all").alias("messages")))
    return wide.select(*by, F.inline(F.array(*rows)))


def message_report(log: DataFrame, latency: Column, buckets: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """Messages by topic and status, and per topic a latency histogram with status ``latency``, from one scan.

    The log is reduced to one row per topic and status first; both answers are made from those few rows.
    """
    counts = [F.count_if(latency <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(buckets)]
    small = log.groupBy("topic", "status").agg(F.count(F.lit(1)).alias("messages"), F.count(latency).alias("_all"), *counts)
    whole = small.groupBy("topic").agg(
        F.collect_list(F.struct("status", "messages")).alias("_status"), F.sum("_all").alias("_all"),
        *[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(len(buckets))])
    rows = [F.struct(F.lit("latency").alias("status"), F.lit(b).cast("double").alias("le"), F.col(f"_b{i}").alias("messages"))
            for i, b in enumerate(buckets)]
    rows.append(F.struct(F.lit("latency").alias("status"), F.lit(None).cast("double").alias("le"), F.col("_all").alias("messages")))
    states = F.transform("_status", lambda s: F.struct(s["status"].alias("status"), F.lit(None).cast("double").alias("le"),
                                                       s["messages"].alias("messages")))
    return whole.select("topic", F.inline(F.concat(F.array(*rows), states)))


def storage_metrics(spark: SparkSession, tables: Mapping[str, str], layer: str) -> DataFrame:
    """Rows, bytes and files of every table, by name and path."""
    out: DataFrame | None = None
    for name, path in tables.items():
        row = file_stats(spark, path).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count",
                                       "size_bytes", "file_count")
        out = row if out is None else out.unionByName(row)
    return out


def job_run_report(runs: DataFrame) -> DataFrame:
    """Runs by job and status with their duration, and the latest error."""
    seconds = F.expr("timestampdiff(SECOND, started_at, completed_at)")
    latest = F.max_by("error_message", F.when(F.col("error_message").isNotNull(), F.struct("started_at", "run_id")))
    return runs.groupBy("job_name", "status").agg(
        F.count(F.lit(1)).alias("runs"), F.sum(seconds).alias("total_seconds"), F.max(seconds).alias("longest_seconds"),
        latest.alias("last_error"))


def audit_report(log: DataFrame, unit: str = "day") -> DataFrame:
    """Actions by user, action and resource over time."""
    period = F.date_trunc(unit, "timestamp").cast("timestamp_ntz").alias("period")
    return log.groupBy("user_id", "action", "resource_type", period).agg(
        F.count(F.lit(1)).alias("actions"), F.min("timestamp").alias("first_at"), F.max("timestamp").alias("last_at"))
