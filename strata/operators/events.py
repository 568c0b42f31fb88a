"""Event records: parse, serialise, validate, route, enrich, publish, dead-letter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from strata.functions import events as ev
from strata.functions.text import trim_unicode
from strata.operators.plan import computed_once


def parse(df: DataFrame, value: str = "value") -> DataFrame:
    """Envelope columns from JSON text, next to the input columns.

    Missing metadata becomes an empty map, a missing version ``1.0``; unreadable text stays in ``_corrupt_record``.
    """
    fields = [*ev.ENVELOPE_COLUMNS, ev.CORRUPT]
    parsed = computed_once(df.drop(*fields), ev.parse_envelope(F.col(value)))
    return parsed.withColumns({
        "metadata": F.coalesce("metadata", ev.empty_map()),
        "schema_version": F.coalesce("schema_version", F.lit(ev.SCHEMA_VERSION)),
    })


def serialize(df: DataFrame, alias: str = "value") -> DataFrame:
    """The envelope as JSON text. A payload that is JSON goes in as JSON, any other text as a JSON string."""
    payload = F.coalesce(F.try_parse_json("payload"), F.parse_json(_quoted(F.col("payload"))))
    others = [F.col(c) for c in ev.ENVELOPE_COLUMNS if c != "payload"]
    return df.withColumn(alias, F.to_json(F.struct(*others, payload.alias("payload"))))


def validate(df: DataFrame) -> DataFrame:
    """Add ``errors``: what is wrong with each envelope, in a fixed order."""
    return computed_once(df.drop("errors"), F.struct(ev.envelope_errors().alias("errors")))


def typed(df: DataFrame, event_type: str) -> DataFrame:
    """Events of one type with their payload as typed columns."""
    of_type = df.filter(F.col("event_type") == event_type).select(
        "event_id", "event_timestamp", "source_system", "payload")
    return computed_once(of_type, ev.parse_payload(F.col("payload"), event_type)).drop("payload")


def route(df: DataFrame, topic: str | None = None) -> DataFrame:
    """Add the target ``topic``: the given one, or by event type."""
    return df.withColumn("topic", F.lit(topic) if topic else ev.topic_for(F.col("event_type")))


def enrich(df: DataFrame, ingested_at: Column) -> DataFrame:
    """Stamp the metadata; the input frame is left as it is."""
    return df.withColumn("metadata", ev.enriched_metadata(F.col("metadata"), ingested_at))


def wrap_raw(
    df: DataFrame, data: Column, source_system: str, stamped_at: Column,
    event_type: str = "raw_data", event_id: Column | None = None, position: Sequence[Column] = (),
) -> DataFrame:
    """Arbitrary JSON data as an event, unchecked.

    Without an id, the md5 of the data and of its ``position`` in the source (topic, partition and offset, or file and
    row) is the id: records with equal data stay apart, and a repeated read gives the same ids.
    """
    if event_id is None and not position:
        raise ValueError("give event_id, or the position of the data in its source")
    generated = F.md5(F.to_json(F.struct(data.alias("data"), *[p.alias(f"p{i}") for i, p in enumerate(position)]),
                                {"ignoreNullFields": "false"})) if position else F.lit(None).cast("string")
    return df.select(
        (F.coalesce(event_id.cast("string"), generated) if event_id is not None else generated).alias("event_id"),
        F.lit(event_type).alias("event_type"),
        stamped_at.alias("event_timestamp"),
        F.lit(source_system).alias("source_system"),
        data.alias("payload"),
        ev.empty_map().alias("metadata"),
        F.lit(ev.SCHEMA_VERSION).alias("schema_version"),
    )


def publish(df: DataFrame, ingested_at: Column, topic: str | None = None, check: bool = True) -> DataFrame:
    """Envelopes ready to send: ``errors``, ``topic``, enriched metadata and ``ok``."""
    checked = validate(df) if check else df.withColumn("errors", F.array().cast("array<string>"))
    return enrich(route(checked, topic), ingested_at).withColumn("ok", F.size("errors") == 0)


def publish_totals(published: DataFrame) -> DataFrame:
    """How many events went to each topic and how many failed."""
    return published.groupBy("topic").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("successful"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def split_dead_letters(messages: DataFrame, failed_at: Column) -> tuple[DataFrame, DataFrame]:
    """Valid messages, and dead letters that keep topic, partition, offset and the value as received."""
    good = messages.filter(F.size("errors") == 0)
    dead = messages.filter(F.size("errors") > 0).select(
        F.lit(ev.DEAD_LETTER_TOPIC).alias("topic"),
        F.col("topic").alias("original_topic"),
        F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"),
        F.col("value").alias("original_value"),
        F.array_join("errors", "; ").alias("error"),
        failed_at.alias("failed_at"),
    )
    return good, dead


def trim_payload(payload: Column) -> Column:
    """Trim string values one level deep in a payload map."""
    return F.transform_values(payload, lambda _, v: trim_unicode(v))


def trim_payload_json(payload: Column) -> Column:
    """Trim string values one level deep in payload text that holds a JSON object; other text is left alone.

    Only values that are JSON strings change: numbers, nested objects and arrays are written back as they were. The
    text is parsed once; what is no object comes out of that as NULL.
    """
    trimmed = F.transform_values(
        F.from_json(payload, "map<string,variant>"),
        lambda _, v: F.when(F.schema_of_variant(v) == "STRING",
                            trim_unicode(F.try_variant_get(v, "$", "string")).cast("variant")).otherwise(v))
    return F.coalesce(F.to_json(trimmed), payload)


def _quoted(text: Column) -> Column:
    """Text as a JSON string literal."""
    listed = F.to_json(F.array(text))
    return listed.substr(F.lit(2), F.length(listed) - 2)
