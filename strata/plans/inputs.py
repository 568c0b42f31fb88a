"""Event envelopes and message logs derived from the ``events`` table, for Spark and for the oracle.

``events`` is clean, so the derivation adds what the operators are there for: several event types, envelopes
without metadata or version, empty ids, bad timestamps, payloads that are arrays, and text that is no JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.functions import events as ev
from strata.operators import messages
from strata.plans.registry import table

# SQL both engines read the same way.
TYPE = """CASE WHEN event_id % 13 = 0 THEN 'log_event' WHEN event_id % 11 = 0 THEN 'custom'
    WHEN event_id % 7 = 0 THEN 'metric_event' WHEN event_type IN ('click', 'view', 'signup') THEN 'user_action'
    WHEN event_type = 'purchase' THEN 'transaction' ELSE 'system_event' END"""
EVENT_ID = "CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(event_id AS STRING) END"
SOURCE = "concat('src', CAST(user_id % 4 AS STRING))"
TRACE = "CASE WHEN user_id % 2 = 0 THEN concat('t', CAST(user_id AS STRING)) END"
VERSION = "CASE WHEN user_id % 3 = 0 THEN '2.0' END"
BAD_TIME = "event_id % 89 = 0"
BAD_PAYLOAD = "event_id % 83 = 0"
BROKEN = "event_id % 101 = 0"
SEVERITY = "CASE WHEN value > 50 THEN 'high' ELSE 'low' END"

# The oracle's view of the same rows.
K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
STAMP_SQL = f"CASE WHEN {BAD_TIME} THEN 'not-a-time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END"
TOPIC_SQL = """CASE etype WHEN 'user_action' THEN 'raw-events' WHEN 'transaction' THEN 'raw-transactions'
    WHEN 'system_event' THEN 'raw-system-events' WHEN 'sensor_reading' THEN 'raw-sensor-data'
    WHEN 'log_event' THEN 'raw-logs' WHEN 'metric_event' THEN 'raw-metrics' ELSE 'raw-events' END"""
BUCKET_SQL = "CAST(CAST('0x' || substr(md5(CAST(user_id AS VARCHAR)), 1, 7) AS BIGINT) % 6 AS INTEGER)"
ENVELOPES_SQL = f"""
    SELECT *, {TOPIC_SQL} AS topic, concat_ws('; ',
        CASE WHEN eid = '' THEN 'event_id is required' END,
        CASE WHEN bad_payload THEN 'payload must be a dictionary' END,
        CASE WHEN bad_time THEN 'event_timestamp must be valid ISO 8601 format' END) AS errors
    FROM (SELECT event_id AS src_id, {EVENT_ID} AS eid, {TYPE} AS etype, {STAMP_SQL} AS stamp, {SOURCE} AS source,
                 {TRACE} AS trace, coalesce({VERSION}, '1.0') AS version, {BAD_TIME} AS bad_time,
                 {BAD_PAYLOAD} AS bad_payload, {BROKEN} AS broken, {K_SQL} AS k, {SEVERITY} AS severity,
                 {BUCKET_SQL} AS part, event_id, ts, user_id, event_type, value
          FROM events)
"""


def payload_text() -> Column:
    """Payload JSON of an event; string values of system events carry stray white space."""
    etype, k = F.col("etype"), F.get_json_object("props", "$.k")
    user = F.to_json(F.struct(F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("action"),
                              F.concat(F.lit("r"), k).alias("resource")))
    transaction = F.to_json(F.struct(
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("transaction_id"),
        F.col("value").alias("amount"), F.lit("USD").alias("currency"),
        F.col("event_type").alias("transaction_type")))
    system = F.to_json(F.struct(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("component"),
        F.col("event_type").alias("event_name"), F.expr(SEVERITY).alias("severity"),
        F.concat(F.lit("  \t"), F.lit("code "), k, F.lit(" ")).alias("message")))
    metric = F.to_json(F.struct(
        F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"),
        F.lit("usd").alias("metric_unit"), F.create_map(F.lit("k"), k).alias("tags")))
    return (
        F.when(F.expr(BAD_PAYLOAD), F.lit("[1,2]"))
        .when(etype == "user_action", user).when(etype == "transaction", transaction)
        .when(etype == "system_event", system).when(etype == "metric_event", metric)
        .otherwise(F.col("props"))
    )


def envelopes_of(events: DataFrame, *extra: str) -> DataFrame:
    """Envelope columns plus ``src_id``, ``ts``, ``user_id`` and ``extra``; works on streams as well."""
    shaped = events.withColumn("etype", F.expr(TYPE))
    return shaped.select(
        F.col("event_id").alias("src_id"), "ts", "user_id", "value", *extra,
        F.expr(EVENT_ID).alias("event_id"),
        F.col("etype").alias("event_type"),
        F.when(F.expr(BAD_TIME), F.lit("not-a-time")).otherwise(ev.iso_text(F.col("ts"))).alias("event_timestamp"),
        F.expr(SOURCE).alias("source_system"),
        payload_text().alias("payload"),
        F.expr(f"CASE WHEN user_id % 2 = 0 THEN map('trace', {TRACE}) END").alias("metadata"),
        F.expr(VERSION).alias("schema_version"),
        F.expr(BROKEN).alias("broken"),
    )


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed envelopes with the defaults filled in."""
    return envelopes_of(table(spark, sf, "events")).withColumns({
        "metadata": F.coalesce("metadata", ev.empty_map()),
        "schema_version": F.coalesce("schema_version", F.lit(ev.SCHEMA_VERSION)),
    })


def envelope_json(shaped: DataFrame) -> DataFrame:
    """Add the envelope as JSON ``value``; absent fields are left out, and some texts are cut off."""
    whole = F.to_json(F.struct("event_id", "event_type", "event_timestamp", "source_system",
                               F.parse_json("payload").alias("payload"), "metadata", "schema_version"))
    return shaped.withColumn("json", F.when(F.col("broken"), F.lit('{"event_id": ')).otherwise(whole))


def log_of(events: DataFrame) -> DataFrame:
    """Kafka-shaped message log. The event id is the offset: it rises with time, and partitions have gaps."""
    shaped = envelope_json(envelopes_of(events)).withColumn(
        "schema_version", F.coalesce("schema_version", F.lit(ev.SCHEMA_VERSION)))
    encoded = messages.encode(
        shaped.withColumnRenamed("value", "amount").withColumnRenamed("json", "value"), "value", "user_id",
        ["event_type", "source_system", "schema_version"], value_format="string")
    return messages.partition_by_key(encoded, "user_id", 6).select(
        "key", "value", ev.topic_for(F.col("event_type")).alias("topic"), "partition",
        F.col("src_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"), "headers")


def log(spark: SparkSession, sf: str) -> DataFrame:
    return log_of(table(spark, sf, "events"))
