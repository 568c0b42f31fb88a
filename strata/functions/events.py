"""Event envelope: schema, parsing, validation, routing and enrichment as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The event types and the topic each one goes to.
TOPIC_ROUTES = {
    "user_action": "raw-events",
    "transaction": "raw-transactions",
    "system_event": "raw-system-events",
    "sensor_reading": "raw-sensor-data",
    "log_event": "raw-logs",
    "metric_event": "raw-metrics",
}
DEFAULT_TOPIC = "raw-events"
DEAD_LETTER_TOPIC = "dead-letter-queue"

# What enrichment adds, and the schema version an event has when it names none.
INGESTION_SYSTEM = "dataplatform"
PRODUCER_VERSION = "1.0.0"
SCHEMA_VERSION = "1.0"

# Messages of the envelope checks, in the order they are reported.
REQUIRED_FIELDS = ("event_id", "event_type", "event_timestamp", "source_system")
PAYLOAD_ERROR = "payload must be a dictionary"
TIMESTAMP_ERROR = "event_timestamp must be valid ISO 8601 format"

# ISO 8601 as dates are read: extended or compact, calendar or week date, then any one character and a time of day.
_EXTENDED_TIME = r"([01][0-9]|2[0-3])(:[0-5][0-9](:[0-5][0-9]([.,][0-9]+)?)?)?"
_COMPACT_TIME = r"([01][0-9]|2[0-3])([0-5][0-9]([0-5][0-9]([.,][0-9]+)?)?)?"
_TIME = f"({_EXTENDED_TIME}|{_COMPACT_TIME})"
CALENDAR_PATTERN = f"^([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{8}})(.{_TIME}([+-]{_TIME})?)?$"
WEEK_PATTERN = f"^([0-9]{{4}}-W[0-9]{{2}}(-[1-7])?|[0-9]{{4}}W[0-9]{{2}}[1-7]?)(.{_TIME}([+-]{_TIME})?)?$"

ENVELOPE = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("schema_version", T.StringType()),
])
ENVELOPE_COLUMNS = tuple(f.name for f in ENVELOPE.fields)
CORRUPT = "_corrupt_record"

PAYLOADS = {
    "user_action": T.StructType([
        T.StructField("user_id", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("resource", T.StringType()),
    ]),
    "transaction": T.StructType([
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
    ]),
    "system_event": T.StructType([
        T.StructField("component", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
    ]),
    "metric_event": T.StructType([
        T.StructField("metric_name", T.StringType()),
        T.StructField("metric_value", T.DoubleType()),
        T.StructField("metric_unit", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]),
}


def parse_envelope(value: Column) -> Column:
    """JSON text to an envelope struct; text that is no JSON object is kept in ``_corrupt_record``."""
    schema = T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def parse_payload(payload: Column, event_type: str) -> Column:
    """Typed payload of one event type."""
    if event_type not in PAYLOADS:
        raise ValueError(f"no typed payload for event type {event_type!r}")
    return F.from_json(payload, PAYLOADS[event_type])


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def is_json_object(text: Column) -> Column:
    return F.json_object_keys(text).isNotNull()


def is_iso_timestamp(text: Column) -> Column:
    """ISO 8601 date or date-time. The patterns fix the form and the time; the calendar decides about the date."""
    whole = F.replace(text, F.lit("Z"), F.lit("+00:00"))
    day = F.regexp_replace(F.left(whole, F.lit(10)), "^([0-9]{4})-?([0-9]{2})-?([0-9]{2}).*$", "$1-$2-$3")
    calendar = whole.rlike(CALENDAR_PATTERN) & (F.left(day, F.lit(4)) != "0000") & day.try_cast("date").isNotNull()
    # The 28th of December is always in the last week of its year.
    last_week = F.weekofyear(F.concat(F.left(whole, F.lit(4)), F.lit("-12-28")).try_cast("date"))
    week = F.regexp_extract(whole, "W([0-9]{2})", 1).try_cast("int")
    by_week = whole.rlike(WEEK_PATTERN) & (F.left(whole, F.lit(4)) != "0000") & week.between(1, last_week)
    return F.coalesce(calendar | by_week, F.lit(False))


def envelope_errors(prefix: str = "") -> Column:
    """Everything wrong with an envelope, in a fixed order; an empty list means it is valid."""
    checks = [
        F.when(F.coalesce(F.col(prefix + name), F.lit("")) == "", F.lit(f"{name} is required"))
        for name in REQUIRED_FIELDS
    ]
    checks.append(F.when(~is_json_object(F.coalesce(F.col(prefix + "payload"), F.lit(""))), F.lit(PAYLOAD_ERROR)))
    checks.append(F.when(~is_iso_timestamp(F.col(prefix + "event_timestamp")), F.lit(TIMESTAMP_ERROR)))
    return F.array_compact(F.array(*checks))


def topic_for(event_type: Column) -> Column:
    """Topic of an event type; unknown types go to the default topic."""
    routes = F.create_map(*[F.lit(x) for pair in TOPIC_ROUTES.items() for x in pair])
    return F.coalesce(F.try_element_at(routes, event_type), F.lit(DEFAULT_TOPIC))


def enriched_metadata(metadata: Column, ingested_at: Column) -> Column:
    """Metadata plus ingestion stamp, system and producer version; these win over keys the sender set."""
    added = F.create_map(
        F.lit("ingestion_timestamp"), ingested_at,
        F.lit("ingestion_system"), F.lit(INGESTION_SYSTEM),
        F.lit("producer_version"), F.lit(PRODUCER_VERSION),
    )
    kept = F.map_filter(F.coalesce(metadata, empty_map()),
                        lambda k, _: ~k.isin("ingestion_timestamp", "ingestion_system", "producer_version"))
    return F.map_concat(kept, added)


def iso_text(ts: Column) -> Column:
    """UTC date-time as ISO text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
