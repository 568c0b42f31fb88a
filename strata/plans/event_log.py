"""Event record and message log queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strata.cluster import checkpointed
from strata.functions import events as ev
from strata.operators import events, messages
from strata.operators.plan import computed_once
from strata.plans.inputs import ENVELOPES_SQL, envelope_json, envelopes, envelopes_of, log
from strata.plans.registry import ntz, register, table
from strata.sources.kafka import TOPIC_RETENTION_MS

NOW = "2024-02-01T00:00:00.000000Z"

# ---- event records ------------------------------------------------------------------------------------------


@register("event_parse", f"""
    SELECT src_id, CASE WHEN NOT broken THEN eid END AS event_id, CASE WHEN NOT broken THEN etype END AS event_type,
           CASE WHEN NOT broken THEN stamp END AS event_timestamp,
           CASE WHEN NOT broken THEN source END AS source_system, CASE WHEN NOT broken THEN trace END AS trace,
           CASE WHEN broken OR trace IS NULL THEN 0 ELSE 1 END AS metadata_keys,
           CASE WHEN broken THEN '1.0' ELSE version END AS schema_version,
           CASE WHEN broken THEN '{{"event_id": ' END AS _corrupt_record
    FROM ({ENVELOPES_SQL})
""")
def event_parse(spark: SparkSession, sf: str) -> DataFrame:
    raw = envelope_json(envelopes_of(table(spark, sf, "events"))).select("src_id", "json")
    return events.parse(raw, "json").select(
        "src_id", "event_id", "event_type", "event_timestamp", "source_system",
        F.col("metadata")["trace"].alias("trace"), F.size("metadata").alias("metadata_keys"), "schema_version",
        ev.CORRUPT)


@register("event_serialize", f"""
    SELECT src_id, eid AS event_id, etype AS event_type, stamp AS event_timestamp, trace, version AS schema_version,
           CASE WHEN etype = 'transaction' AND NOT bad_payload THEN value END AS amount,
           CASE WHEN etype = 'user_action' AND NOT bad_payload THEN 'r' || k END AS resource,
           CASE WHEN bad_payload THEN '2' END AS second_item
    FROM ({ENVELOPES_SQL})
""")
def event_serialize(spark: SparkSession, sf: str) -> DataFrame:
    out = events.serialize(envelopes(spark, sf), "json").select("src_id", "json")
    read = F.from_json("json", "event_id STRING, event_type STRING, event_timestamp STRING, "
                               "metadata STRUCT<trace: STRING>, schema_version STRING, payload STRING")
    return computed_once(out, read).select(
        "src_id", "event_id", "event_type", "event_timestamp", F.col("metadata.trace").alias("trace"), "schema_version",
        F.get_json_object("payload", "$.amount").cast("double").alias("amount"),
        F.get_json_object("payload", "$.resource").alias("resource"),
        F.get_json_object("payload", "$[1]").alias("second_item"))


@register("event_validate", f"SELECT src_id, errors FROM ({ENVELOPES_SQL})")
def event_validate(spark: SparkSession, sf: str) -> DataFrame:
    return events.validate(envelopes(spark, sf)).select("src_id", F.array_join("errors", "; ").alias("errors"))


def _typed_sql(event_type: str, fields: str) -> str:
    return f"""
        SELECT eid AS event_id, stamp AS event_timestamp, source AS source_system, {fields}
        FROM ({ENVELOPES_SQL}) WHERE etype = '{event_type}' AND NOT bad_payload
    """


def _typed(spark: SparkSession, sf: str, event_type: str) -> DataFrame:
    good = envelopes(spark, sf).filter(ev.is_json_object(F.col("payload")))
    return events.typed(good, event_type)


@register("event_payload_user_action", _typed_sql(
    "user_action", "CAST(user_id AS VARCHAR) AS user_id, event_type AS action, 'r' || k AS resource"))
def event_payload_user_action(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf, "user_action")


@register("event_payload_transaction", _typed_sql(
    "transaction", "'t' || src_id AS transaction_id, value AS amount, 'USD' AS currency, "
                   "event_type AS transaction_type"))
def event_payload_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf, "transaction")


@register("event_payload_system", _typed_sql(
    "system_event", "'c' || user_id AS component, event_type AS event_name, severity, "
                    "'  ' || chr(9) || 'code ' || k || ' ' AS message"))
def event_payload_system(spark: SparkSession, sf: str) -> DataFrame:
    return _typed(spark, sf, "system_event")


@register("event_payload_metric", _typed_sql(
    "metric_event", "event_type AS metric_name, value AS metric_value, 'usd' AS metric_unit, "
                    "CAST(k AS VARCHAR) AS tag_k"))
def event_payload_metric(spark: SparkSession, sf: str) -> DataFrame:
    out = _typed(spark, sf, "metric_event")
    return out.withColumn("tag_k", F.col("tags")["k"]).drop("tags")


@register("event_route", f"SELECT src_id, etype AS event_type, topic FROM ({ENVELOPES_SQL})")
def event_route(spark: SparkSession, sf: str) -> DataFrame:
    return events.route(envelopes(spark, sf)).select("src_id", "event_type", "topic")


@register("event_enrich", f"""
    SELECT src_id, trace, '{NOW}' AS ingestion_timestamp, 'dataplatform' AS ingestion_system,
           '1.0.0' AS producer_version, CASE WHEN trace IS NULL THEN 3 ELSE 4 END AS metadata_keys
    FROM ({ENVELOPES_SQL})
""")
def event_enrich(spark: SparkSession, sf: str) -> DataFrame:
    out = events.enrich(envelopes(spark, sf), F.lit(NOW))
    meta = F.col("metadata")
    return out.select("src_id", meta["trace"].alias("trace"),
                      meta["ingestion_timestamp"].alias("ingestion_timestamp"),
                      meta["ingestion_system"].alias("ingestion_system"),
                      meta["producer_version"].alias("producer_version"), F.size(meta).alias("metadata_keys"))


@register("event_wrap_raw", f"""
    SELECT md5('{{"data":' || to_json(props) || ',"p0":' || event_id || '}}') AS event_id, 'raw_data' AS event_type, '{NOW}' AS event_timestamp, 'app' AS source_system,
           props AS payload, 0 AS metadata_keys, '1.0' AS schema_version
    FROM events
""")
def event_wrap_raw(spark: SparkSession, sf: str) -> DataFrame:
    out = events.wrap_raw(table(spark, sf, "events"), F.col("props"), "app", F.lit(NOW),
                          position=[F.col("event_id")])
    return out.withColumn("metadata_keys", F.size("metadata")).drop("metadata")


@register("event_publish_batch", f"""
    SELECT topic, count(*) AS total, count(*) FILTER (errors = '') AS successful,
           count(*) FILTER (errors <> '') AS failed
    FROM ({ENVELOPES_SQL}) GROUP BY topic
""")
def event_publish_batch(spark: SparkSession, sf: str) -> DataFrame:
    return events.publish_totals(events.publish(envelopes(spark, sf), F.lit(NOW)))


@register("event_dead_letter", f"""
    SELECT 'dead-letter-queue' AS topic, topic AS original_topic, part AS original_partition,
           src_id AS original_offset, broken AS truncated,
           CASE WHEN broken THEN concat_ws('; ', 'event_id is required', 'event_type is required',
                'event_timestamp is required', 'source_system is required', 'payload must be a dictionary',
                'event_timestamp must be valid ISO 8601 format') ELSE errors END AS error,
           TIMESTAMP '2024-02-01 00:00:00' AS failed_at
    FROM ({ENVELOPES_SQL}) WHERE errors <> '' OR broken
""")
def event_dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    decoded = messages.decode(log(spark, sf), "string")
    checked = events.validate(events.parse(decoded))
    dead = events.split_dead_letters(checked, ntz("2024-02-01"))[1]
    return dead.withColumn("truncated", F.col("original_value") == '{"event_id": ').drop("original_value")


# ---- message log --------------------------------------------------------------------------------------------

_LOG_SQL = f"""
    SELECT topic, part AS "partition", src_id AS "offset", CAST(user_id AS VARCHAR) AS "key", ts AS "timestamp",
           user_id, value AS amount, etype, eid, source, version, broken
    FROM ({ENVELOPES_SQL})
"""


@register("message_encode", f"""
    SELECT topic, "partition", "offset", hex("key") AS "key", 'event_type=' || etype || ',source_system=' || source
           || ',schema_version=' || version AS headers, CAST(NOT broken AS INTEGER) AS complete
    FROM ({_LOG_SQL})
""")
def message_encode(spark: SparkSession, sf: str) -> DataFrame:
    header = F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string")))
    return log(spark, sf).select(
        "topic", "partition", "offset", F.hex("key").alias("key"), F.array_join(header, ",").alias("headers"),
        F.endswith("value", F.lit(b"}")).cast("int").alias("complete"))


@register("message_decode", f"""
    SELECT topic, "partition", "offset", "key", "timestamp", CASE WHEN NOT broken THEN eid END AS event_id,
           etype AS header_type, source AS header_source, 3 AS headers,
           CASE WHEN broken THEN 'value is not JSON' END AS decode_error
    FROM ({_LOG_SQL})
""")
def message_decode(spark: SparkSession, sf: str) -> DataFrame:
    out = messages.decode(log(spark, sf))
    return out.select(
        "topic", "partition", "offset", "key", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.get_json_object("value", "$.event_id").alias("event_id"),
        F.col("headers")["event_type"].alias("header_type"), F.col("headers")["source_system"].alias("header_source"),
        F.size("headers").alias("headers"), "decode_error")


@register("message_key_partition", f"""
    SELECT "partition", "key", count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset
    FROM ({_LOG_SQL}) GROUP BY ALL
""")
def message_key_partition(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).groupBy("partition", F.col("key").cast("string").alias("key")).agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))


@register("topic_select", f"""
    SELECT topic, "partition", "offset", 'pattern' AS how FROM ({_LOG_SQL})
    WHERE regexp_full_match(topic, 'raw-(events|metrics)')
    UNION ALL SELECT topic, "partition", "offset", 'list' FROM ({_LOG_SQL})
    WHERE topic IN ('raw-transactions', 'raw-logs')
""")
def topic_select(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["topic", "partition", "offset"]
    by_pattern = messages.select_topics(log(spark, sf), pattern="raw-(events|metrics)").select(*columns)
    by_list = messages.select_topics(log(spark, sf), ["raw-transactions", "raw-logs"]).select(*columns)
    return by_pattern.withColumn("how", F.lit("pattern")).union(by_list.withColumn("how", F.lit("list")))


@register("offset_range_read", f"""
    SELECT topic, "partition", "offset", "key" FROM ({_LOG_SQL}) JOIN (
        SELECT topic, "partition", (min("offset") + max("offset") + 1) // 2 AS from_offset,
               CASE WHEN "partition" = 0 THEN NULL ELSE max("offset") - 100 END AS to_offset
        FROM ({_LOG_SQL}) GROUP BY topic, "partition") USING (topic, "partition")
    WHERE "offset" >= from_offset AND (to_offset IS NULL OR "offset" < to_offset)
""")
def offset_range_read(spark: SparkSession, sf: str) -> DataFrame:
    """Replay every partition from its middle; partition 0 to the end, the others to 100 before the last offset."""
    ranges = messages.watermarks(log(spark, sf)).select(
        "topic", "partition", F.expr("(earliest + latest) div 2").alias("from_offset"),
        F.expr("CASE WHEN `partition` = 0 THEN NULL ELSE latest - 101 END").alias("to_offset"))
    return messages.offset_range(log(spark, sf), ranges).select(
        "topic", "partition", "offset", F.col("key").cast("string").alias("key"))


@register("batch_cap", f"""
    SELECT topic, "partition", "offset" FROM (
        SELECT *, row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS rn FROM ({_LOG_SQL}))
    WHERE rn <= 50
""")
def batch_cap(spark: SparkSession, sf: str) -> DataFrame:
    """One poll of at most 50 messages per partition."""
    return messages.next_batch(log(spark, sf), limit=50).select("topic", "partition", "offset")


@register("offset_watermarks", f"""
    SELECT topic, "partition", min("offset") AS earliest, max("offset") + 1 AS latest
    FROM ({_LOG_SQL}) GROUP BY topic, "partition"
""")
def offset_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    return messages.watermarks(log(spark, sf))


@register("offset_commit_next", f"""
    SELECT 'loader' AS group_id, topic, "partition", max("offset") + 1 AS position
    FROM ({_LOG_SQL}) WHERE "timestamp" < TIMESTAMP '2024-01-15' GROUP BY topic, "partition"
""")
def offset_commit_next(spark: SparkSession, sf: str) -> DataFrame:
    processed = log(spark, sf).filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp"))
    return messages.commit_positions(processed, "loader")


@register("consumer_lag", f"""
    WITH marks AS (SELECT topic, "partition", max("offset") + 1 AS latest FROM ({_LOG_SQL}) GROUP BY ALL),
    commits AS (
        SELECT 'loader' AS group_id, topic, "partition", max("offset") + 1 AS position FROM ({_LOG_SQL})
        WHERE "timestamp" < TIMESTAMP '2024-01-15' GROUP BY ALL
        UNION ALL SELECT 'monitor', topic, "partition", max("offset") + 1 FROM ({_LOG_SQL})
        WHERE "timestamp" < TIMESTAMP '2024-01-20' AND topic = 'raw-events' AND "partition" < 2 GROUP BY ALL)
    SELECT g.group_id, topic, m."partition", coalesce(position, 0) AS position, latest,
           latest - coalesce(position, 0) AS lag
    FROM marks m JOIN (SELECT DISTINCT group_id, topic FROM commits) g USING (topic)
    LEFT JOIN commits c USING (group_id, topic, "partition")
""")
def consumer_lag(spark: SparkSession, sf: str) -> DataFrame:
    """Two groups: one behind on every topic, one that committed only two partitions of one topic."""
    def read_to(day: str) -> Column:
        return (F.max(F.when(F.col("timestamp") < F.lit(day).cast("timestamp"), F.col("offset"))) + 1)

    # One scan of the log gives everything that is asked of a partition.
    seen = checkpointed(log(spark, sf).groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("latest"), read_to("2024-01-15").alias("loader"), read_to("2024-01-20").alias("monitor")))
    loader = seen.filter("loader IS NOT NULL").select(F.lit("loader").alias("group_id"), "topic", "partition", F.col("loader").alias("position"))
    monitor = seen.filter("monitor IS NOT NULL AND topic = 'raw-events' AND partition < 2").select(
        F.lit("monitor").alias("group_id"), "topic", "partition", F.col("monitor").alias("position"))
    return messages.consumer_lag(seen.select("topic", "partition", "latest"), loader.union(monitor))


@register("topic_describe", f"""
    SELECT topic, count(DISTINCT "partition") AS num_partitions, count(*) AS messages
    FROM ({_LOG_SQL}) GROUP BY topic
""")
def topic_describe(spark: SparkSession, sf: str) -> DataFrame:
    return messages.describe_topics(log(spark, sf))


@register("topic_compact", f"""
    SELECT topic, "partition", "offset", "key" FROM (
        SELECT *, row_number() OVER (PARTITION BY topic, "key" ORDER BY "offset" DESC) AS rn FROM ({_LOG_SQL}))
    WHERE rn = 1 AND NOT broken
""")
def topic_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Messages whose text was cut off stand for tombstones."""
    source = log(spark, sf).withColumn(
        "value", F.when(F.endswith("value", F.lit(b"}")), F.col("value")))
    return messages.compact(source).select("topic", "partition", "offset", F.col("key").cast("string").alias("key"))


@register("topic_retention", f"""
    SELECT topic, "partition", "offset" FROM ({_LOG_SQL})
    WHERE topic <> 'raw-events' OR "timestamp" >= TIMESTAMP '2024-02-01' - INTERVAL 7 DAY
""")
def topic_retention(spark: SparkSession, sf: str) -> DataFrame:
    kept = messages.retain(log(spark, sf), TOPIC_RETENTION_MS, F.lit("2024-02-01").cast("timestamp"))
    return kept.select("topic", "partition", "offset")
