"""Kafka connector options in one place. The connector jar comes with the cluster; the rest works on log tables."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter

# The row of the Kafka source.
LOG_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]))),
])


def offsets_json(offsets: Mapping[tuple[str, int], int]) -> str:
    """Offsets option text, e.g. ``{"raw-events":{"0":5}}``; -2 is the beginning, -1 the end."""
    out: dict[str, dict[str, int]] = {}
    for (topic, partition), offset in offsets.items():
        out.setdefault(topic, {})[str(partition)] = offset
    return json.dumps(out)


def source_options(
    servers: str, topics: Sequence[str] | None = None, pattern: str | None = None,
    starting: str | Mapping[tuple[str, int], int] = "earliest",
    ending: str | Mapping[tuple[str, int], int] | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source for a list of topics or a pattern."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or pattern")
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": "true"}
    options.update({"subscribe": ",".join(topics)} if topics is not None else {"subscribePattern": pattern})
    options["startingOffsets"] = starting if isinstance(starting, str) else offsets_json(starting)
    if ending is not None:
        options["endingOffsets"] = ending if isinstance(ending, str) else offsets_json(ending)
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_log(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("kafka").options(**source_options(**options)).load()


def stream_log(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**source_options(**options)).load()


def write_log(df: DataFrame, servers: str) -> None:
    df.select("topic", "key", "value", "headers").write.format("kafka").option(
        "kafka.bootstrap.servers", servers).option("includeHeaders", "true").save()


def stream_to_log(df: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    return df.select("topic", "key", "value", "headers").writeStream.format("kafka").option(
        "kafka.bootstrap.servers", servers).option("checkpointLocation", checkpoint)


# Retention of the platform's topics in milliseconds.
TOPIC_RETENTION_MS = {
    "raw-events": 604800000,
    "cdc-streams": 2592000000,
    "api-events": 604800000,
    "mcp-requests": 259200000,
    "dead-letter-queue": 2592000000,
    "bronze-events": 7776000000,
    "silver-events": 63072000000,
    "gold-events": 220752000000,
    "data-quality-results": 2592000000,
    "lineage-events": 2592000000,
    "agent-requests": 604800000,
    "agent-responses": 604800000,
}
